"""Near-duplicate documents by ProbMinHash.

A document is a multiset of shingles of five words.  Every shingle starts a Poisson process whose rate is its count in
the document and whose randomness depends on the shingle alone.  Each arrival falls on a random register; the register
keeps the shingle that arrives there first.  Arrivals of a shingle come in order of time, so a shingle is done as soon as
it is later than the latest first arrival of all registers.  Two documents agree in a register with the probability that
is their probability Jaccard similarity.  Registers are banded; documents that share a band are candidates, and
candidates are verified by the similarity itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import blocks, released, stored
from oremill.llm.components import components

SHINGLE_WORDS, LEAST = 5, 0.8
#: At a similarity of 0.8 a pair shares no band with probability 3e-6.
BANDS, BAND_ROWS = 32, 5
#: Odd sketches have so many words of 64 bits, and the weight of a document's shingles is spread over so many buckets.
ODD_WORDS, SPREAD = 16, 128
#: Shares of a spread are whole numbers of parts of this size.
PARTS = 32_767
#: Documents whose registers are filled at once.
AT_ONCE = 400
#: Components are worked out anew when the links found since are more than this part of those before.
RENEWED = 20
#: Candidates are looked up by a broadcast while their ids stay below this, else by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Words remembered by each Python worker; a full memory is emptied.
REMEMBERED = 150_000

_WORD = re.compile(r"[^\W_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # of SplitMix64
_hashes: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case; a text without any is one word, unless it is blank."""
    found = _WORD.findall(text.lower()) if text else []
    return found or ([text.strip()] if text and text.strip() else [])


def _hash(word: str) -> int:
    known = _hashes.get(word)
    if known is None:
        if len(_hashes) >= REMEMBERED:
            _hashes.clear()
        known = _hashes[word] = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")
    return known


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles in ascending order and their counts.  Fewer than five words are one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known = list(map(_hashes.get, words))
    if None in known:
        known = [_hash(w) if k is None else k for w, k in zip(words, known, strict=True)]
    each = np.array(known, np.uint64)
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    with np.errstate(over="ignore"):
        joined = each[:n].copy()
        for at in range(1, min(SHINGLE_WORDS, len(words))):
            joined = _mix(joined) + each[at : at + n]
        if len(words) < SHINGLE_WORDS:
            joined = joined + np.uint64(len(words))
        return np.unique(_mix(joined), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * BAND_ROWS) -> np.ndarray:
    """The registers of several documents: a row each.  Every set has a shingle."""
    parts = [_signatures(sets[at : at + AT_ONCE], registers) for at in range(0, len(sets), AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty((0, registers), np.uint64)


def _signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """All first arrivals at once, then the second ones of the shingles that are still going, and so on."""
    d = len(sets)
    element = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(float)
    doc = np.repeat(np.arange(d), [len(s) for s, _ in sets])
    first = np.full(d * m, np.inf)
    winner = np.zeros(d * m, np.uint64)
    time, latest, arrival = np.zeros(len(element)), np.full(d, np.inf), np.uint64(0)
    with np.errstate(over="ignore"):
        while len(element):
            arrival += np.uint64(1)
            random = _mix(element ^ _mix(np.full(1, arrival))[0])
            time = time - np.log(((random >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate
            register = doc * m + (_mix(random) % np.uint64(m)).astype(np.int64)
            np.minimum.at(first, register, time)
            won = first[register] == time
            winner[register[won]] = element[won]
            changed = np.unique(doc[won])
            latest[changed] = first.reshape(d, m)[changed].max(axis=1)
            going = time < latest[doc]
            element, rate, doc, time = element[going], rate[going], doc[going], time[going]
    return winner.reshape(d, m)


def bands_of(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each document."""
    parts = registers.reshape(len(registers), BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
        for at in range(BAND_ROWS):
            key = _mix(key ^ parts[:, :, at]) + key
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: the sum over common shingles i of 1 / sum over all j of max(a_j / a_i, b_j / b_i)."""
    (x, nx), (y, ny) = a, b
    _, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(ix):
        return 0.0
    cx, cy = nx[ix], ny[iy]
    only_x, only_y = nx.sum() - cx.sum(), ny.sum() - cy.sum()
    pairs, times = np.unique(np.stack([cx, cy]), axis=1, return_counts=True)
    total = 0.0
    for (p, q), n in zip(pairs.T, times, strict=True):
        total += n / ((np.maximum(pairs[0] / p, pairs[1] / q) * times).sum() + only_x / p + only_y / q)
    return float(total)


def odd_sketch(shingle: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of shingles falls on them, in words of 64."""
    with np.errstate(over="ignore"):
        place = (_mix(shingle) % np.uint64(64 * ODD_WORDS)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=64 * ODD_WORDS).astype(np.uint8) & 1).view(np.int64)


def spread(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The share of a document's shingles that falls into each bucket of a hash, rounded to whole parts."""
    with np.errstate(over="ignore"):
        place = (_mix(~shingle) % np.uint64(SPREAD)).astype(np.int64)
    return np.rint(np.bincount(place, weights=count, minlength=SPREAD) / max(1, count.sum()) * PARTS).astype(np.int16)


def _repeated(shingle: np.ndarray, count: np.ndarray) -> int:
    """A hash of the shingles that occur more than once, with their counts."""
    some = count > 1
    data = shingle[some].tobytes() + count[some].astype(np.int64).tobytes()
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _pack(found: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Shingles; counts if any is not one; and a byte that says so."""
    shingle, count = found
    counted = bool((count != 1).any())
    return shingle.tobytes() + (count.astype(np.uint32).tobytes() if counted else b"") + bytes([counted])


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    counted = data[-1]
    n = (len(data) - 1) // (12 if counted else 8)
    return np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint32, n, 8 * n).astype(np.int64) if counted else np.ones(n, np.int64)


def sketches(documents: DataFrame, text: str = "text") -> DataFrame:
    """Of each document with a word: ``doc_id``, ``at`` (hash of the text), ``print`` (of the words) and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            worded = [words_of(t) for t in block.column("text").to_pylist()]
            some = [at for at, w in enumerate(worded) if w]
            if not some:
                continue
            prints = [blake2b(" ".join(worded[at]).encode(), digest_size=16).digest() for at in some]
            # Copies within the block are worked out once.
            once = {p: at for p, at in zip(prints, some, strict=True)}
            order = {p: row for row, p in enumerate(once)}
            keys = bands_of(signatures([shingles(worded[at]) for at in once.values()]))
            flat = keys[[order[p] for p in prints]].reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            kept = block.take(pa.array(some))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), kept.column("at"), pa.array(prints, pa.binary()), lists], ["doc_id", "at", "print", "bands"])

    rows = documents.select("doc_id", F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("at"))
    return rows.mapInArrow(released(run), "doc_id long, at long, print binary, bands array<long>")


def _vectors(documents: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """Of the documents with ``node`` in ``wanted``: shingles, how many in total and above one each, a hash of these, the odd
    sketch, and the spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = [shingles(words_of(t)) for t in block.column("text").to_pylist()]
            packed = pa.array([_pack(f) for f in found], pa.binary())
            totals, more = (pa.array(n, pa.int64()) for n in ([int(c.sum()) for _, c in found], [int(c.sum()) - len(c) for _, c in found]))
            repeated = pa.array([_repeated(*f) for f in found], pa.int64())
            odd = pa.array([odd_sketch(s) for s, _ in found], pa.list_(pa.int64()))
            spreads = pa.array([spread(*f) for f in found], pa.list_(pa.int16()))
            columns = [block.column("node"), packed, totals, more, repeated, odd, spreads]
            yield pa.RecordBatch.from_arrays(columns, ["node", "vector", "total", "more", "repeated", "odd", "spread"])

    rows = documents.select("doc_id", F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("at"))
    small = wanted.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(wanted) if small else wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["at"] == wanted["at"]))
    once = joined.select("node", "text").dropDuplicates(["node"])  # rows that repeat an id and a text
    return stored(once.mapInArrow(released(run), "node long, vector binary, total long, more long, repeated long, odd array<long>, spread array<short>"), "vectors")


def _verified(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar enough.  A node of very many pairs is split by Spark's skew join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "va"):
            found = [similarity(_unpack(x), _unpack(y)) >= least for x, y in zip(block.column("va").to_pylist(), block.column("vb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("a"), block.column("b")], ["a", "b"]).filter(pa.array(found, pa.bool_()))

    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(released(run), "a long, b long")


def _unsettled(unled: DataFrame, roots: DataFrame) -> DataFrame:
    """Of buckets the members that have not led, with their component, where they are of several components."""
    placed = unled.join(roots, "node", "left").select("key", "node", "weight", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") < F.col("high"))
    return stored(placed.join(stored(split.select("key"), "split"), "key", "left_semi"), "unsettled")


def _likely(least: float) -> Column:
    """Whether documents (``x`` and ``y``) may be similar enough, by their odd sketches: no pair that is gets lost.

    Let T be all shingles of both, w those of shingles that only one of them has, and d the differences of the counts of common
    shingles.  A common shingle of counts a and b adds at most max(a, b) to the similarity, over the sum of all larger counts, so
    that is at most (T + d - w) / (T + d + w).  There are at least as many shingles that only one has as there are unlike bits;
    d is 0 if both repeat the same shingles as often, and else at most what they repeat.
    """

    only = sum((F.bit_count(F.col(f"x.o{i}").bitwiseXOR(F.col(f"y.o{i}"))) for i in range(ODD_WORDS)), F.lit(0))
    differ = F.when(F.col("x.repeated") == F.col("y.repeated"), 0).otherwise(F.col("x.more") + F.col("y.more"))
    all_of = F.col("x.total") + F.col("y.total") + differ
    return all_of - only >= (least - 1e-9) * (all_of + only)


def _close(least: float) -> Column:
    """The same by their spreads: the similarity is at most the sum over all shingles of the smaller of their shares in the two
    documents, so that it is at most one less half of the difference of all shares.  Adding up shares within a bucket before
    taking differences can only make these smaller, and rounding them changes each by a part at most."""
    apart = F.aggregate(F.zip_with("x.spread", "y.spread", lambda a, b: F.abs(a - b).cast("int")), F.lit(0), lambda total, d: total + d)
    return apart <= (2 * (1 - least) + 1e-9) * PARTS + SPREAD


def _at_best(least: float) -> Column:
    """The same by the similarity of the spreads themselves, which is that of the documents or more.

    Let two shingles of weights x1, x2 and y1, y2 fall into one bucket, with x2 / x1 = r at least y2 / y1 = s, and let D1 and D2
    be the sums that their parts of the similarity are one over.  Let U be the sum of x_j / x1 of all others with
    x_j / (x1 + x2) >= y_j / (y1 + y2), and V that of y_j / y1 of the rest.  Then D1 >= (1 + r) + U + V and
    D2 >= (1 + 1 / s) + U / r + V / s.  One over the sum of one over each is superadditive, so 1 / (1 / D1 + 1 / D2) is at least
    1 + U / (1 + r) + V / (1 + s), the sum of the bucket; those of other shingles only get smaller.

    A sum over larger ratios is no smaller than one that takes each bucket's ratio from either document: from ``x`` for buckets
    that come before in the order of x / y, from ``y`` for the rest.  Shares are within half a part of what they were rounded to.
    """
    half = F.lit(0.5)
    low = lambda share: F.greatest(share - half, F.lit(0.0))
    each = F.zip_with("x.spread", "y.spread", lambda p, q: F.struct(((p + half) / (q + half)).alias("ratio"), p.cast("double").alias("p"), q.cast("double").alias("q")))
    rest = F.aggregate("y.spread", F.lit(0.0), lambda total, q: total + low(q.cast("double")))

    def step(so_far: Column, of: Column) -> Column:
        rest = so_far["rest"] - low(of["q"])
        part = 1 / (1 + so_far["before"] / (of["p"] + half) + rest / (of["q"] + half))
        return F.struct((so_far["before"] + low(of["p"])).alias("before"), rest.alias("rest"), (so_far["total"] + part).alias("total"))

    start = F.struct(F.lit(0.0).alias("before"), rest.alias("rest"), F.lit(0.0).alias("total"))
    return F.aggregate(F.sort_array(each, asc=False), start, step, lambda end: end["total"]) >= least - 1e-9


def _possible(members: DataFrame, leaders: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` of a member and a leader of a bucket, of unlike components, that the bounds do not rule out.  The
    bounds are applied from the cheapest to the dearest.

    Where both sides of a bucket are large, Spark would split both and have a task for each pair of splits.  Of an outer join it
    splits the members only, so that the tasks grow with the members; members without a pair go at once.
    """
    once = F.array_min(F.array_intersect("x.bands", "y.bands")) == members["key"]
    both = members.join(leaders, (members["key"] == leaders["key"]) & (F.col("root") != F.col("lead_root")) & _likely(least) & _close(least) & once & _at_best(least), "left")
    pairs = both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return pairs.where(F.col("a") != F.col("b"))  # the least and the greatest of one node and none are that node


def classes(spark: SparkSession, documents: DataFrame, least: float = LEAST, text: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``at``, ``class_id`` and ``kept``.

    Documents are near-duplicates if the probability Jaccard similarity of their shingles is at least ``least``; a class
    is what such links connect, and its id the smallest ``doc_id`` in it.  Of each class that document is kept.  Texts
    with the same words are copies and are compared as one.  A text of fewer than five words is a shingle by itself; a
    null or blank text is in a class of its own.  A null ``doc_id`` is larger than any other; documents of one id are
    told apart by the text (``at`` is its hash), and rows that repeat both are one document.

    Candidates are all that share a band.  In a bucket a leader is compared with all other members, never all members with
    each other: what the links found so far connect needs no comparison.  The first leader is the member with the most
    company in all its buckets: of edited copies that is the least edited, and it links with most of them.  Where members
    that have not led are of several components, 32 times as many leaders are taken, until that leaves none; of their pairs
    those are compared that bounds do not rule out, each in one of the buckets that the two share.
    """
    rows = stored(sketches(documents, text), "sketches")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")).alias("best")
    nodes = rows.groupBy("print").agg(best, F.first("bands").alias("bands"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "print", "best", "bands"), "nodes")
    places = nodes.select("node", F.explode("bands").alias("key"))
    shared = places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = stored(shared, "buckets")  # the join below then has a shuffle of its own, in which a large bucket is split
    crowded = stored(places.join(shared, "key"), "crowded")
    company = crowded.groupBy("node").agg(F.sum("n").alias("weight"))  # a node is in as many buckets as there are bands
    members = stored(crowded.select("key", "node").join(company, "node"), "members")
    first = F.max(F.struct("weight", (-F.col("node")).alias("node"))).alias("lead")
    leads = stored(members.groupBy("key").agg(first).select("key", (-F.col("lead.node")).alias("lead")), "leads")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "best.doc_id", "best.at")
    vectors = _vectors(documents, stored(wanted, "wanted"), text)
    led = members.join(leads, "key").where(F.col("node") != F.col("lead"))
    pairs = led.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    tested = stored(pairs, "pairs")
    edges = stored(_verified(tested, vectors, least), "links")
    words = [F.col("odd")[i].alias(f"o{i}") for i in range(ODD_WORDS)]
    sketch = vectors.join(nodes.select("node", "bands"), "node").select("node", F.struct("node", "total", "more", "repeated", "bands", "spread", *words).alias("y"))
    sketch = stored(sketch, "bounds")
    unled = led.select("key", "node", "weight")
    leaders, roots, placed, waiting = 1, components(edges, "documents"), edges.count(), 0
    while True:
        left = _unsettled(unled, roots)
        leaders *= 32
        salt = F.pmod(F.xxhash64("node", F.lit(leaders)), F.lit(leaders)).alias("salt")
        chosen = left.groupBy("key", salt).agg(F.max(F.struct("weight", (-F.col("node")).alias("node"), "root")).alias("lead"))
        chosen = stored(chosen.select("key", (-F.col("lead.node")).alias("node"), F.col("lead.root").alias("lead_root")), "leaders")
        if chosen.isEmpty():
            break
        led = chosen.join(sketch, "node").select("key", "lead_root", F.col("y").alias("x"))
        pairs = _possible(left.join(sketch, "node").select("key", "root", "y"), led, least).distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        found = stored(_verified(pairs, vectors, least), "links")
        more = found.count()
        if more:
            edges, waiting = edges.unionByName(found), waiting + more
        # Components that lag behind by few links cost comparisons that they would save, and no result.
        if waiting * RENEWED > placed:
            roots, placed, waiting = components(edges, "documents"), placed + waiting, 0
        unled = left.select("key", "node", "weight").join(chosen.select("key", "node"), ["key", "node"], "left_anti")
    if waiting:
        roots = components(edges, "documents")
    return _answer(documents, text, rows, nodes, roots)


def _answer(documents: DataFrame, text: str, rows: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    placed = nodes.select("node", "print", "best").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = stored(placed.groupBy("root").agg(F.min("best").alias("head")), "heads")
    of_print = placed.join(heads, "root").select("print", "head")
    same = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("at") == F.col("head.at"))
    linked = rows.select("doc_id", "at", "print").join(of_print, "print").select("doc_id", "at", F.col("head.doc_id").alias("class_id"), same.alias("kept"))
    blank = documents.where(F.col(text).isNull() | (F.regexp_like(F.col(text), F.lit(r"^[\s\p{Z}\x1c-\x1f\x85]*$"))))
    alone = blank.select("doc_id", F.xxhash64(F.col(text)).alias("at"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def near_duplicates(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document: its class, and whether it is the one that stays."""
    return classes(spark, documents).select("doc_id", "class_id", "kept")
