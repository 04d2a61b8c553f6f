"""Hard negatives for training embeddings, by a secondary sort.

Every anchor has a few positives, the best scored rows of its own label.  A hard negative of a positive is a row of another
label whose score lies in a window below the positive's.  Pairs of an anchor and a row are packed into keys of the anchor,
the descending score and the id; ``repartitionAndSortWithinPartitions`` deals keys by anchor and sorts them by all of it.
An iterator then streams over the sorted keys: a positive opens its window, a row of another label goes to the windows it
falls in, and a window closes when it has enough.  No anchor's rows are ever held together.

Scores are computed in blocks of anchors by blocks of rows, joined by cells of the grid that they make.  A block keeps only
the pairs that can be among the first: first the best of the anchor's label, and, once the positives are known, the best of
each window.  So what is shuffled follows the number of anchors and blocks, not of pairs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import stored

#: Rows and anchors of a block; a pair of blocks has so many scores in memory.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 512
#: Row blocks of a cell at most; with fewer blocks there are as many cells as a shuffle has partitions.
CELL_BLOCKS = 256

_LONG = 1 << 63
#: Anchor, inverted score, whether it is no positive, whether the id is null, id, row.
_KEY = struct.Struct(">QQBBQQ")
_KEYS = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("other", "u1"), ("none", "u1"), ("id", ">u8"), ("row", ">u8")])

_PARTS = ("rows", "ids", "nones", "labels", "data")


def _packed(vectors: DataFrame, most: int, scale: float) -> DataFrame:
    """Blocks of vectors of one size: their rows, ids, labels, and components times ``scale``, rounded down; with the
    scores of their positives, if there is such a column."""
    extra = ["positives"] if "positives" in vectors.columns else []
    schema = pa.schema([("size", pa.int32()), *[(n, pa.binary()) for n in _PARTS], *[(c, pa.list_(pa.list_(pa.int64()))) for c in extra]])

    def block(batch: pa.RecordBatch) -> Iterator[dict]:
        sizes = np.array([len(v) for v in batch.column("vector").to_pylist()], np.int64)
        ids = batch.column("vec_id")
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            part = batch.take(pa.array(at))
            with np.errstate(over="ignore"):
                data = np.floor(scale * part.column("vector").flatten().to_numpy(zero_copy_only=False)).reshape(len(at), size)
            data = np.nan_to_num(data, posinf=np.finfo(float).max, neginf=-np.finfo(float).max)
            short = not data.size or np.abs(data).max() < 1 << 24
            yield {
                "size": int(size),
                "rows": part.column("row").to_numpy().astype(np.int64).tobytes(),
                "ids": ids.take(pa.array(at)).fill_null(0).to_numpy().astype(np.int64).tobytes(),
                "nones": ids.take(pa.array(at)).is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                "labels": part.column("label").to_numpy().astype(np.int64).tobytes(),
                "data": data.astype(np.float32 if short else np.float64).tobytes(),
                **{c: part.column(c).to_pylist() for c in extra},
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == most:
                    yield pa.RecordBatch.from_pylist(list(block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])), schema)
                    held, count = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(list(block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])), schema)

    kinds = ", ".join(["size int", *[f"{n} binary" for n in _PARTS], *[f"{c} array<array<long>>" for c in extra]])
    return vectors.select("row", "vec_id", "label", F.col("vector").cast("array<double>").alias("vector"), *extra).mapInArrow(run, kinds)


class Block:
    """A block of vectors, in the order of ids, nulls last, and rows."""

    def __init__(self, size: int, rows: bytes, ids: bytes, nones: bytes, labels: bytes, data: bytes, positives: list[list[int]] | None = None):
        row, vec_id, label = (np.frombuffer(x, np.int64) for x in (rows, ids, labels))
        none = np.frombuffer(nones, np.uint8)
        order = np.lexsort((row, vec_id, none))
        self.positives = [positives[at] for at in order] if positives else []
        wide = np.float64 if len(data) == 8 * size * len(row) else np.float32
        self.rows, self.ids, self.nones, self.labels = row[order], vec_id[order], none[order], label[order]
        self.data = np.frombuffer(data, wide).reshape(len(row), size)[order].astype(np.float64)
        #: Products of sums of as many components as these are exact in doubles.
        self.small = np.abs(self.data).max(axis=1, initial=0) ** 2 * max(size, 1) < 1 << 52


def scores(anchors: Block, others: Block) -> np.ndarray:
    """Exact inner products, held in 64 bits: beyond these a score is the largest or smallest there is."""
    with np.errstate(over="ignore", invalid="ignore"):
        product = anchors.data @ others.data.T
    exact = np.outer(anchors.small, others.small)
    found = np.where(exact, product, 0).astype(np.int64)
    for a, b in zip(*np.nonzero(~exact), strict=True):
        total = sum(int(x) * int(y) for x, y in zip(anchors.data[a], others.data[b], strict=True))
        found[a, b] = max(-_LONG, min(_LONG - 1, total))
    return found


def _first(score: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Which of the allowed columns are the first ``count`` of each row, by descending score, then by column."""
    width = score.shape[1]
    if width <= count:
        return allowed
    if max(int(score.max(initial=0)), -int(score.min(initial=0))) < (1 << 61) // width:
        rank = np.where(allowed, score * width - np.arange(width), -(1 << 62))
        best = np.partition(rank, width - count, axis=1)[:, width - count]
        return allowed & (rank >= best[:, None])
    order = np.lexsort((np.broadcast_to(np.arange(width), score.shape), np.where(allowed, ~score, 0), ~allowed), axis=1)
    chosen = np.zeros_like(allowed)
    np.put_along_axis(chosen, order[:, :count], True, axis=1)
    return allowed & chosen


def _keys(anchors: Block, others: Block, score: np.ndarray, chosen: np.ndarray, positive: bool) -> pa.Array:
    a, b = np.nonzero(chosen)
    keys = np.empty(len(a), _KEYS)
    keys["anchor"] = anchors.rows[a]
    keys["score"] = _inverted(score[a, b])
    keys["other"] = not positive
    keys["none"], keys["row"] = others.nones[b], others.rows[b]
    keys["id"] = others.ids[b].view(np.uint64) ^ np.uint64(_LONG)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.size), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def _inverted(score: np.ndarray) -> np.ndarray:
    return ~(score.view(np.uint64) ^ np.uint64(_LONG))


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores from ``low`` to ``high`` hundredths of ``score``, both included; none if the first is larger."""
    return -(-low * score // 100), high * score // 100


def _block(x: dict, name: str) -> Block:
    return Block(x["size"], *(x[f"{name}_{part}"] for part in _PARTS), x.get(f"{name}_positives"))


def _grid(anchors: DataFrame, others: DataFrame) -> DataFrame:
    """Each block of anchors beside each block of rows of vectors as long."""
    count = others.count()
    cells = max(1, -(-count // CELL_BLOCKS), min(count, int(others.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    at = F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell")
    rest = [c for c in anchors.columns if c != "size"]
    left = anchors.select("size", at, *[F.col(c).alias(f"a_{c}") for c in rest])
    cell = F.pmod(F.xxhash64("rows"), F.lit(cells)).cast("int").alias("cell")
    right = others.select("size", cell, *[F.col(c).alias(f"b_{c}") for c in _PARTS])
    # A task's work follows the pairs of blocks and not its bytes, so partitions are not to be merged.
    by = ["size", "cell"]
    return left.repartition(cells, *by).join(right.repartition(cells, *by), by)


def _selected(grid: DataFrame, select) -> RDD:
    """Keys of the pairs that ``select`` chooses for a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                x = batch.slice(at, 1).to_pylist()[0]
                anchors, others = _block(x, "a"), _block(x, "b")
                keys = select(anchors, others)
                if len(keys):
                    yield pa.RecordBatch.from_arrays([keys], ["key"])

    return grid.mapInArrow(run, "key binary").rdd.map(lambda r: (bytes(r[0]), None))


def _sorted(pairs: RDD, partitions: int) -> RDD:
    return pairs.repartitionAndSortWithinPartitions(partitions, _deal)


def _deal(key: bytes) -> int:
    return int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 % _LONG >> 20


def _unpacked(key: bytes) -> tuple[int, int, bool, int | None]:
    """Anchor, score, whether it is a positive, and id."""
    anchor, score, other, none, vec_id, _ = _KEY.unpack(key)
    return anchor, (_LONG - 1) - score, not other, None if none else vec_id - _LONG


def _best(count: int):
    """Of sorted pairs the first of each anchor."""

    def run(stream: Iterator[tuple[bytes, None]]) -> Iterator[bytes]:
        for _, pairs in groupby(stream, key=lambda pair: pair[0][:8]):
            for place, (key, _) in enumerate(pairs):
                if place < count:
                    yield key

    return run


def _mined(count: int, low: int, high: int):
    """Negatives of sorted pairs: anchor, positive, rank, negative and both scores."""

    def run(stream: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        anchor, windows = None, []
        for key, _ in stream:
            now, score, positive, vec_id = _unpacked(key)
            if now != anchor:
                anchor, windows = now, []
            if positive:
                windows.append([vec_id, score, *window(score, low, high), 0])
                continue
            for opened in windows:
                positive_id, of, least, most, found = opened
                if found < count and least <= score <= most:
                    opened[4] += 1
                    yield anchor, positive_id, opened[4], vec_id, of, score

    return run


def usable(label: str = "label", vector: str = "vector") -> Column:
    """Whether a row takes part: it has a label and a vector, and every component is a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))


def mine(
    spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` (a whole number) and ``vector``; other columns are ignored.  Components are
    multiplied by ``scale`` and rounded down.  An anchor's positives are the first ``positives`` other rows of its label;
    to each belong the first ``negatives`` rows of other labels whose scores are between ``low`` and ``high`` hundredths
    of the positive's.  Higher scores come first, ties go by the smaller id.

    Rows without a label, a vector, or with a component that is null or not finite take no part.  Rows that repeat an id
    are rows of their own, and so anchors of their own: among equal scores and ids any order of them gives the same
    result.  A null id is larger than any other; it is no anchor unless ``is_anchor`` says so.  Vectors of unlike sizes
    have no score, empty ones the score 0.  Scores that 64 bits cannot hold are the largest or smallest that they can.
    An empty table, or one without anchors, gives no rows.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("windows have to lie within 0 and 100 hundredths of a positive's score")
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "vector", F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    # Stored, so that a row keeps its number whatever is lost.
    rows = stored(rows.where(usable()).select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    others = stored(_packed(rows, BLOCK_ROWS, scale), "blocks")
    queries = rows.where("asks").select("row", "vec_id", "label", "vector")
    spread = max(1, -(-queries.count() // BLOCK_ANCHORS))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def of_label(anchors: Block, others: Block) -> pa.Array:
        score = scores(anchors, others)
        same = (anchors.labels[:, None] == others.labels) & (anchors.rows[:, None] != others.rows)
        return _keys(anchors, others, score, _first(score, same, positives), True)

    asked = _packed(queries.repartition(spread), BLOCK_ANCHORS, scale)
    best = _sorted(_selected(_grid(asked, others), of_label), partitions).mapPartitions(_best(positives))
    scored = best.map(lambda key: (*_unpacked(key)[:2], key))
    best = stored(spark.createDataFrame(scored, "row long, score long, key binary", verifySchema=False), "positives")

    def in_windows(anchors: Block, others: Block) -> pa.Array:
        score = scores(anchors, others)
        unlike = anchors.labels[:, None] != others.labels
        chosen = np.zeros(score.shape, bool)
        for n in range(positives):
            least, most = np.array([window(of[n], low, high) if n < len(of) else (1, 0) for of in anchors.positives], np.int64).reshape(-1, 2).T
            chosen |= _first(score, unlike & (score >= least[:, None]) & (score <= most[:, None]), negatives)
        return _keys(anchors, others, score, chosen, False)

    # A row for each anchor that has a positive, with as many scores as it has positives.
    windows = best.groupBy("row").agg(F.collect_list("score").alias("positives"))
    asked = _packed(queries.join(windows, "row").repartition(spread), BLOCK_ANCHORS, scale)
    pairs = _selected(_grid(asked, others), in_windows).union(best.rdd.map(lambda r: (bytes(r["key"]), None)))
    found = _sorted(pairs, partitions).mapPartitions(_mined(negatives, low, high))
    schema = "row long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    mined = spark.createDataFrame(found, schema, verifySchema=False)
    ids = queries.select("row", F.col("vec_id").alias("anchor_id"))
    return mined.join(ids, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """The rows of ``embeddings`` with ids divisible by 100 are anchors; labels of ids divisible by 7 are moved by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = embeddings.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return mine(spark, vectors, F.col("vec_id") % 100 == 0)
