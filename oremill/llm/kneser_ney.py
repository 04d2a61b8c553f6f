"""Language-model scoring: an interpolated modified Kneser-Ney model of n-grams.

Documents are read in blocks.  A block finds its different n-grams, deals them to shards by their hashes, and sends each
shard one packed list.  A shard adds up what all blocks have sent: that is the model, sorted arrays of 64-bit hashes with
their counts, stored as a table of shards.  While a worker has a shard it maps the arrays into memory and looks up there
what the blocks asked for.  The answers go back to the blocks, which turn them into probabilities and scores.

Counts of the highest order are occurrences in the training documents.  A lower order counts by how many different words an
n-gram is preceded, and for each context keeps how much follows it, and how many different words follow it once, twice and
more often; the shards of the next order send both down.  So there is no array of the whole model in one place: a shard
holds its share, a block what it has asked for, and the driver sees sums alone.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from oremill.llm.common import blocks, mix64, release, released
from oremill.llm.lang_id import fold
from oremill.session import scratch_dir

#: The order of the query's model.
ORDER = 2
#: Bytes of text in a block, and for each shard.  Lists between them are as many as blocks times shards: for tens of terabytes
#: raise both with the memory of a worker.
BLOCK_BYTES, SHARD_BYTES = 10 << 20, 24 << 20
#: Weight of a word that was not seen, in the base score.
UNSEEN = 0.1
#: Discounts of n-grams counted once, twice and more often, where counts of counts cannot tell them.
DISCOUNTS = (0.5, 1.0, 1.5)

# Neither of them can be a word: words hold no blanks.
END, START = xxh3_64_intdigest(b"end of text "), xxh3_64_intdigest(b"start of text ")

#: What is kept of an n-gram: its count; as a context, all that follows and how many words follow once, twice, more often;
#: and, of words, their occurrences.
COUNT, FOLLOWED, ONCE, TWICE, OFTEN, SEEN = range(6)
#: Sums over an order: n-grams counted 1, 2, 3, 4, and 3 or more times; counts; occurrences; different words.
TOTALS = 8

TABLE, FACT, ASK, ANSWER, TOTAL, BLOCK = "0-table", "1-fact", "2-ask", "3-answer", "4-total", "5-block"
_SCHEMA = "kind string, level int, shard long, block long, data binary, totals array<long>"
_ARROW = pa.schema([("kind", pa.string()), ("level", pa.int32()), ("shard", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("totals", pa.list_(pa.int64()))])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value, byte planes compressed apart: most numbers leave their high bytes empty."""
    z = zstandard.ZstdCompressor(level=1)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() if x.size else b"" for x in arrays]
    return pickle.dumps([(x.dtype.str, x.shape, z.compress(p)) for x, p in zip(arrays, planes, strict=True)])


def unpack(data: bytes) -> list[np.ndarray]:
    found = []
    for kind, shape, packed in pickle.loads(data):
        kind = np.dtype(kind)
        plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        found.append(np.ascontiguousarray(plain.reshape(kind.itemsize, -1).T).view(kind).reshape(shape))
    return found


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _sums(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=gaps.dtype)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in ascending order, and the place of each key among them."""
    codes, found = pd.factorize(keys)
    order = np.argsort(found)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return found[order], place[codes]


def gram_hash(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(prefix) + word


def words_hash(words: np.ndarray) -> np.ndarray:
    """The hashes of n-grams, a row of word hashes each."""
    found = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        found = gram_hash(found, words[:, k])
    return found


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(hashes) >> np.uint64(8)) % np.uint64(shards)


def tokens(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII blanks, A to Z in lower case; the end of the text is not among them."""
    return text.encode().lower().split() if text else []


class Level:
    """The different n-grams of one order in a block, in the order of their words: hashes, and where their parts are one
    order below."""

    def __init__(self, vocabulary: np.ndarray, ids: np.ndarray, place: np.ndarray, lower: Level | None, order: int):
        self.at = np.flatnonzero(place >= order - 1).astype(np.int32)  # positions in which an n-gram ends
        self.lower, self.vocabulary = lower, vocabulary
        if lower is None:
            self.hashes, self.of = vocabulary, ids
            return
        key = lower.of[self.at - 1].astype(np.uint64) * np.uint64(len(vocabulary)) + ids[self.at].astype(np.uint64)
        keys, of = distinct(key)
        self.last = (keys % np.uint64(len(vocabulary))).astype(np.int32)
        self.prefix = (keys // np.uint64(len(vocabulary))).astype(np.int32)
        self.suffix = np.empty(len(keys), np.int32)
        self.suffix[of] = lower.of[self.at]
        self.of = np.full(len(ids), -1, np.int32)
        self.of[self.at] = of
        self.hashes = gram_hash(lower.hashes[self.prefix], vocabulary[self.last])

    def words(self, at: np.ndarray) -> np.ndarray:
        """The word hashes of some n-grams, a row each."""
        if self.lower is None:
            return self.vocabulary[at][:, None]
        return np.concatenate([self.lower.words(self.prefix[at]), self.vocabulary[self.last[at]][:, None]], axis=1)


def levels(vocabulary: np.ndarray, ids: np.ndarray, place: np.ndarray, order: int) -> list[Level]:
    found: list[Level] = []
    for k in range(1, order + 1):
        found.append(Level(vocabulary, ids, place, found[-1] if found else None, k))
    return found


def read(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary, word numbers, place in the text, and tokens of each text; texts begin with ``order`` - 1 starts."""
    parts, sizes = [], np.empty(len(texts), np.int64)
    starts, end = np.full(order - 1, START, np.uint64), np.array([END], np.uint64)
    for at, text in enumerate(texts):
        found = tokens(text)
        sizes[at] = len(found) + 1
        parts += [starts, np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found)), end]
    whole = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return (*distinct(whole), _places(sizes, order), sizes)


def _places(sizes: np.ndarray, order: int) -> np.ndarray:
    long = sizes + order - 1
    return np.arange(long.sum(), dtype=np.int32) - np.repeat((np.cumsum(long) - long).astype(np.int32), long)


def _in_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list]]:
    """Number a partition's rows in blocks of about so many bytes: the same numbers whenever the partition is read."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for part in blocks(batches, "text"):
        held.append(part)
        size += part.nbytes
        if size >= most:
            yield number, held
            number, held, size = number + 1, [], 0
    if held:
        yield number, held


def _values(parts: list[pa.RecordBatch], column: str) -> list:
    return [value for part in parts for value in part.column(column).to_pylist()]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{n: r.get(n) for n in _ARROW.names} for r in rows], _ARROW)


def _asked(documents: DataFrame, level: int, order: int, shards: int, block_bytes: int) -> DataFrame:
    """What blocks ask the shards of an order for: lists of n-grams, with how often training documents have them."""

    def ask(block: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, ids, place, sizes = read(_values(parts, "text"), order)
        grams = levels(vocabulary, ids, place, level)[-1]
        learned = np.repeat(np.array(_values(parts, "learned"), bool), sizes + order - 1) & (place >= order - 1)
        counts = np.bincount(grams.of[learned], minlength=len(grams.hashes)).astype(np.int64)
        shard = shard_of(grams.hashes, shards)
        by_shard = np.argsort(shard, kind="stable")
        for at in np.split(by_shard, np.flatnonzero(np.diff(shard[by_shard])) + 1):
            if len(at):
                data = _words_packed(grams.words(at), counts[at])
                yield _batch([{"kind": ASK, "level": level, "shard": int(shard[at[0]]), "block": block, "data": data}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _in_blocks(batches, block_bytes):
            yield from ask(block, parts)
            release()

    return documents.mapInArrow(released(run), _SCHEMA)


def _words_packed(words: np.ndarray, *values: np.ndarray) -> bytes:
    """N-grams in the order of their word hashes as numbers in a list of the different words."""
    known, ids = distinct(words.ravel())
    ids = ids.astype(np.uint32).reshape(words.shape)
    first = np.diff(ids[:, 0], prepend=np.uint32(0)) if len(ids) else ids[:, 0]
    return pack(_gaps(known), first, *ids.T[1:], *values)


def _words_unpacked(data: bytes, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    gaps, first, *rest = unpack(data)
    known = _sums(gaps)
    ids = [np.cumsum(first, dtype=np.uint32), *rest[: order - 1]]
    return np.stack([known[i] for i in ids], axis=1), rest[order - 1 :]


class Mapped:
    """Sorted hashes and a row of counts for each, in a file of this worker that is mapped into memory.

    The file has no name: it is gone with the worker, or as soon as the shard is done.
    """

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.count, columns = values.shape
        if self.count:
            spill = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]  # where Spark spills
            with tempfile.TemporaryFile(dir=spill if os.path.isdir(spill) else None) as file:
                file.write(hashes.tobytes())
                file.write(values.tobytes())
                file.flush()
                whole = np.memmap(file, np.uint64, "r", shape=(self.count * (1 + columns),))
            self.hashes, self.values = whole[: self.count], whole[self.count :].view(np.int64).reshape(values.shape)
        self.none = np.zeros(columns, np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not self.count:
            return np.tile(self.none, (len(hashes), 1))
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.count - 1)
        return np.where((self.hashes[at] == hashes)[:, None], self.values[at], 0)


def _starts(ascending: np.ndarray) -> np.ndarray:
    """Where each of the different values begins."""
    return np.flatnonzero(np.diff(ascending, prepend=~ascending[:1]) != 0) if len(ascending) else np.empty(0, np.int64)


def _added(hashes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes in order, the sums of their values, and where each hash stands first."""
    order = np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    starts = _starts(sorted_hashes)
    sums = np.add.reduceat(values[order], starts, axis=0) if len(order) else values
    return sorted_hashes[starts], sums, order[starts]


def _columns(level: int, order: int) -> int:
    """How much is kept of an n-gram: those of the highest order are no contexts, and no words."""
    return COUNT + 1 if level == order > 1 else SEEN + 1


def _facts(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What n-grams tell about those one shorter: one more word before their ends, and what follows their beginnings."""
    hashes, values, shorter = [], [], []
    told = {FOLLOWED: counts, ONCE: counts == 1, TWICE: counts == 2, OFTEN: counts > 2}
    # Ends and beginnings apart and a column at a time: there are far fewer of either than of n-grams.
    for part, columns in ((words[:, 1:], {COUNT: np.ones(len(words), bool)}), (words[:, :-1], told)):
        every = words_hash(part)
        order = np.argsort(every, kind="stable")
        starts = _starts(every[order])
        sums = np.zeros((len(starts), OFTEN + 1), np.int64)
        for column, value in columns.items():
            sums[:, column] = np.add.reduceat(value[order], starts, dtype=np.int64) if len(order) else 0
        first = order[starts]
        hashes.append(every[first])
        values.append(sums)
        shorter.append(part[first])
    _, sums, first = _added(np.concatenate(hashes), np.concatenate(values))
    return np.concatenate(shorter)[first], sums


def _shards(rows: DataFrame, level: int, order: int, shards: int, learning: bool) -> DataFrame:
    """Add up what came to each shard of an order, answer what was asked, and tell the next order.

    Stored tables and facts come before questions, which count too if the model is being learned.
    """
    columns = _columns(level, order)

    def shard(number: int, parts: Iterator[dict]) -> Iterator[dict]:
        hashes, values, words, asked = [], [], [], []
        for part in parts:
            if part["kind"] == TABLE:
                gaps, stored = unpack(part["data"])
                hashes.append(_sums(gaps))
                values.append(stored.T)
                continue
            grams, rest = _words_unpacked(part["data"], level)
            found = words_hash(grams)
            counted = np.zeros((len(grams), columns), np.int64)
            if part["kind"] == FACT:
                counted[:, : SEEN] = np.stack(rest, axis=1)
            elif learning:
                if level == order:
                    counted[:, COUNT] = rest[0]
                if level == 1:
                    counted[:, SEEN] = rest[0]
            if part["kind"] == ASK:
                asked.append((part["block"], found))
            if learning:
                hashes.append(found)
                values.append(counted)
                words.append(grams)
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        hashes.clear()
        known, sums, first = _added(every, np.concatenate(values) if values else np.zeros((0, columns), np.int64))
        values.clear()
        del every
        some = sums.any(axis=1)
        known, sums, first = known[some], sums[some], first[some]
        if learning and len(known):
            yield {"kind": TABLE, "shard": number, "data": pack(_gaps(known), sums.T)}
            counts = sums[:, COUNT]
            seen = sums[:, SEEN] if columns > SEEN else np.empty(0, np.int64)
            totals = [int(n) for n in (*((counts == c).sum() for c in (1, 2, 3, 4)), (counts > 2).sum(), counts.sum(), seen.sum(), (seen > 0).sum())]
            yield {"kind": TOTAL, "shard": number, "totals": totals}
            if level > 1:
                grams = np.concatenate(words)
                words.clear()
                grams = grams[first[counts > 0]]
                shorter, told = _facts(grams, counts[counts > 0])
                del grams
                order_by = np.lexsort(shorter.T[::-1])
                shorter, told = shorter[order_by], told[order_by]
                to = shard_of(words_hash(shorter), shards)
                by_shard = np.argsort(to, kind="stable")
                for at in np.split(by_shard, np.flatnonzero(np.diff(to[by_shard])) + 1):
                    yield {"kind": FACT, "level": level - 1, "shard": int(to[at[0]]), "data": _words_packed(shorter[at], *told[at].T)}
        model = Mapped(known, sums)
        for block, wanted in asked:
            yield {"kind": ANSWER, "shard": number, "block": block, "data": pack(np.ascontiguousarray(model.find(wanted).T))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for at in range(batch.num_rows) for row in batch.slice(at, 1).to_pylist())
        for number, parts in groupby(stream, key=itemgetter("shard")):
            for row in shard(number, parts):
                yield _batch([{"level": level, **row}])
            release()

    # A task for each shard: shards are of about one size.
    dealt = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "kind", "block")
    return dealt.mapInArrow(released(run), _SCHEMA)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """As a table with a folder for each kind of row, in the shared folder."""
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


@dataclass(frozen=True)
class Model:
    """``tables`` has a row for each order (``level``) and shard: sorted hashes and their counts.  ``totals`` by order."""

    order: int
    shards: int
    tables: DataFrame
    totals: tuple[tuple[int, ...], ...]

    @property
    def tokens(self) -> int:
        return self.totals[0][6]

    @property
    def words(self) -> int:
        return self.totals[0][7]


def discounts(totals: tuple[int, ...]) -> tuple[float, float, float]:
    """What is taken off the counts 1, 2, and 3 and more, from how many n-grams are counted once to four times."""
    n1, n2, n3, n4 = totals[:4]
    if not all((n1, n2, n3, n4)):
        return DISCOUNTS
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return found if all(0 < d < k for k, d in enumerate(found, 1)) else DISCOUNTS


def probabilities(grams: list[Level], values: list[np.ndarray], totals: tuple[tuple[int, ...], ...]) -> np.ndarray:
    """The probability of the last word of each n-gram of the highest order after the words before it."""
    found = np.empty(0)
    for k, (level, counted, total) in enumerate(zip(grams, values, totals, strict=True)):
        d = np.array((0.0, *discounts(total)))
        count = counted[:, COUNT]
        left = count - d[np.minimum(count, 3)]
        if not k:
            rest, follows = float(d[1] * total[0] + d[2] * total[1] + d[3] * total[4]), np.full(len(count), total[5])
            lower = np.full(len(count), 1 / (totals[0][7] + 1))
        else:
            context = values[k - 1][level.prefix]
            rest, follows = context[:, ONCE : OFTEN + 1] @ d[1:], context[:, FOLLOWED]
            lower = found[level.suffix]
        found = np.where(follows > 0, (left + rest * lower) / np.maximum(follows, 1), lower)
    return found


def _read_blocks(documents: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """The words of each block as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _in_blocks(batches, block_bytes):
            vocabulary, ids, _, sizes = read(_values(parts, "text"), order)
            rows = [[r, h] for r, h in zip(_values(parts, "doc_id"), _values(parts, "held_out"), strict=True)]
            doc_id = np.array([r or 0 for r, _ in rows], np.int64)
            flags = np.array([2 * (r is None) + bool(h) for r, h in rows], np.uint8)
            yield _batch([{"kind": BLOCK, "block": block, "data": pack(_gaps(vocabulary), ids.astype(np.uint32), sizes, doc_id, flags)}])

    return documents.mapInArrow(released(run), _SCHEMA)


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _scores(rows: DataFrame, parts: int, order: int, shards: int, totals: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Scores of the documents of each block, from its words and all answers to it."""
    seen, words = totals[0][6], totals[0][7]

    def block(parts: Iterator[dict]) -> pa.RecordBatch:
        answers, data = {}, None
        for part in parts:
            if part["kind"] == ANSWER:
                answers[part["level"], part["shard"]] = part["data"]
            else:
                data = part["data"]
        gaps, ids, sizes, doc_id, flags = unpack(data)
        grams = levels(_sums(gaps), ids.astype(np.int32), _places(sizes, order), order)
        values = []
        for k, level in enumerate(grams, 1):
            counted, shard = np.zeros((len(level.hashes), _columns(k, order)), np.int64), shard_of(level.hashes, shards)
            by_shard = np.argsort(shard, kind="stable")
            for at in np.split(by_shard, np.flatnonzero(np.diff(shard[by_shard])) + 1):
                counted[at] = unpack(answers[k, int(shard[at[0]])])[0].T
            values.append(counted)
        with np.errstate(divide="ignore"):
            log = np.log10(probabilities(grams, values, totals))
            occurs = values[0][:, SEEN]
            base = np.log10((occurs + UNSEEN) / (seen + UNSEEN * (words + 1)))
        at = grams[-1].at
        starts = np.cumsum(sizes) - sizes
        word = grams[0].of[at]
        found = [np.add.reduceat(x, starts) for x in ((occurs > 0)[word].astype(np.int64), base[word], log[grams[-1].of[at]])]
        ids = pa.array(doc_id, mask=flags >= 2)
        return pa.RecordBatch.from_arrays([ids, pa.array((flags & 1).astype(bool)), pa.array(sizes), pa.array(found[0]), pa.array(np.full(len(sizes), seen)), pa.array(found[1]), pa.array(found[2])], schema=_SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for at in range(batch.num_rows) for row in batch.slice(at, 1).to_pylist())
        for _, each in groupby(stream, key=itemgetter("block")):
            yield block(each)
            release()

    dealt = rows.repartition(parts, "block").sortWithinPartitions("block", "kind", "level", "shard")
    return dealt.mapInArrow(released(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _prepared(documents: DataFrame, learned: Column, held_out: Column) -> DataFrame:
    flags = [F.coalesce(c, F.lit(False)).alias(n) for c, n in ((learned, "learned"), (held_out, "held_out"))]
    return documents.select("doc_id", "text", *flags)


def _answered(
    spark: SparkSession, rows: DataFrame, order: int, shards: int, tables: DataFrame | None, totals: tuple | None, block_bytes: int
) -> tuple[DataFrame, Model]:
    """Answers of all orders, the highest first, and the model: learned on the way unless there is one."""
    answers, learned, sums, facts = [], [], [], None
    for level in range(order, 0, -1):
        asked = _asked(rows, level, order, shards, block_bytes)
        if tables is not None:
            asked = asked.unionByName(tables.where(F.col("level") == level))
        elif facts is not None:
            asked = asked.unionByName(facts)
        done = _stored(_shards(asked, level, order, shards, tables is None), f"grams-{level}")
        answers.append(done.where(F.col("kind") == ANSWER))
        facts = done.where(F.col("kind") == FACT)
        learned.append(done.where(F.col("kind") == TABLE))
        if tables is None:
            found = done.where(F.col("kind") == TOTAL).agg(*[F.coalesce(F.sum(F.col("totals")[n]), F.lit(0)).alias(f"t{n}") for n in range(TOTALS)]).first()
            sums.insert(0, tuple(found))
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    if tables is None:
        tables, totals = learned[0], tuple(sums)
        for more in learned[1:]:
            tables = tables.unionByName(more)
    return every, Model(order, shards, tables, totals)


def _text_bytes(documents: DataFrame) -> int:
    return documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def learn_and_score(
    spark: SparkSession, documents: DataFrame, learned: Column, held_out: Column, order: int = ORDER,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, Model]:
    """Learn a model from the rows that ``learned`` marks and score all rows: what is counted and what is asked for travels
    together.

    The scores are ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per document.  Words
    are runs of anything but ASCII blanks, A to Z in lower case; a text ends with one more token.  ``score`` is log10 of the
    model's probability of the text, ``base_score`` that of the words alone.  ``held_out`` is passed through, null as false.

    A null or empty text is its end alone.  Rows that repeat an id are documents of their own, a null id stays null.
    Without rows to learn from each word has the probability of the one word that is not known, 1.  An empty table has no
    scores.  ``documents`` should be a stored table: blocks are numbered by the partitions that they are in.  Other columns
    are ignored.
    """
    rows = _prepared(documents, learned, held_out)
    size = _text_bytes(documents)
    shards = max(1, -(-size // shard_bytes))
    answers, model = _answered(spark, rows, order, shards, None, None, block_bytes)
    return _finished(rows, answers, model, size, block_bytes), model


def score(spark: SparkSession, documents: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of other documents by a model, as in :func:`learn_and_score`; ``held_out`` is true."""
    rows = _prepared(documents, F.lit(False), F.lit(True))
    answers, _ = _answered(spark, rows, model.order, model.shards, model.tables, model.totals, block_bytes)
    return _finished(rows, answers, model, _text_bytes(documents), block_bytes)


def _finished(rows: DataFrame, answers: DataFrame, model: Model, size: int, block_bytes: int) -> DataFrame:
    read_again = _read_blocks(rows, model.order, block_bytes).unionByName(answers)
    parts = max(1, -(-2 * size // block_bytes))
    return _scores(read_again, parts, model.order, model.shards, model.totals)


def scored(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """All documents, by a model of those whose remainder by 10 is not 0; a null id is neither learned from nor held out."""
    remainder = fold("doc_id", 10)
    return learn_and_score(spark, documents, remainder != 0, remainder == 0)[0]
