"""Near-duplicates among embeddings: an exact metric range join.

The metric is the angle.  Pivots, picked from the vectors of each label, partition them: a vector belongs to the cell of
the pivot nearest to it.  A vector can only be within the angle of the threshold of some vector of another cell if two
consequences of the triangle inequality allow it: it is not further from that cell's pivot than the cell's radius and
the threshold together, and not further than the threshold from the border between the two cells.  It is copied to the
cells for which both hold, and then every cell is joined by itself.  Nothing is estimated.

In many dimensions, vectors without any structure are all about equally far from all pivots, and then most cells border
on most others: the join compares all pairs of a label, in blocks, with memory bounded all the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import stored, wide_hash
from oremill.llm.components import components

#: A cell is cut into parts of about so many vectors; vectors copied to a part pass by in blocks of so many.
PART_ROWS, BLOCK_ROWS = 1024, 4096
#: Bound of the pivots sent to all executors.  With fewer pivots cells are larger and have more parts; results are the same.
PIVOT_BYTES = 4 * 1024 * 1024
#: Rounding of angles and dot products that may not cost a link (near 1 the arc cosine is off by 1.5e-8); links are decided on
#: the dot product alone.
SLACK = 1e-7


def _unit(embeddings: list) -> np.ndarray:
    rows = np.asarray(embeddings, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _valid() -> Column:
    """Whether a row can link at all."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _distinct(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different vectors that can link, with how many copies they have; and each valid row's vector."""
    rows = vectors.select("vec_id", "label", "embedding").where(_valid())
    h1, h2 = wide_hash(F.col("label"), F.col("embedding"))
    rows = rows.select("vec_id", F.struct(F.col("label").cast("string").alias("label"), F.size("embedding").alias("size")).alias("kind"), h1.alias("h1"), h2.alias("h2"), "embedding")
    first = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("kind").alias("kind"), F.first("embedding").alias("embedding"))
    return stored(first.withColumn("id", F.monotonically_increasing_id()), "vectors"), rows.select("vec_id", "h1", "h2")


def _pivots(first: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots of the kinds with more vectors than a part holds, about one for each part, as far as the bound goes."""
    size = first.agg(F.max("kind.size")).first()[0]
    if not size:
        return {}
    most = max(1, PIVOT_BYTES // (8 * size))
    kinds = first.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART_ROWS).orderBy(F.desc("n"), "kind").limit(most).collect()
    if not kinds:
        return {}
    wanted = {k["kind"]: -(-k["n"] // PART_ROWS) for k in kinds}
    scale = min(1.0, most / sum(wanted.values()))
    shares = [(k["kind"], max(1.0, wanted[k["kind"]] * scale) / k["n"]) for k in kinds]
    spark = first.sparkSession
    share = spark.createDataFrame(shares, f"kind {first.schema['kind'].dataType.simpleString()}, share double")
    at = F.pmod(F.xxhash64(F.lit("pivot"), "h1", "h2"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    chosen = first.join(F.broadcast(share), "kind").where(at).select("kind", "embedding", "h1").limit(2 * most).collect()
    found: dict[tuple, list] = {}
    for row in sorted(chosen, key=lambda r: (r["kind"], r["h1"])):
        found.setdefault(tuple(row["kind"]), []).append(row["embedding"])
    return {kind: _unit(rows) for kind, rows in found.items()}


def _by_kind(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
    kinds: dict[tuple, list[int]] = {}
    for at, kind in enumerate(batch.column("kind").to_pylist()):
        kinds.setdefault((kind["label"], kind["size"]), []).append(at)
    for kind, rows in kinds.items():
        yield kind, np.array(rows)


def _cells(first: DataFrame, pivots: dict[tuple, np.ndarray]) -> DataFrame:
    """Add the cell of each vector, and its angle to the cell's pivot."""
    shared = first.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            embeddings = batch.column("embedding")
            for kind, rows in _by_kind(batch):
                if kind in shared.value:
                    near = _unit(embeddings.take(pa.array(rows)).to_pylist()) @ shared.value[kind].T
                    cell[rows] = near.argmax(axis=1)
                    angle[rows] = np.arccos(np.clip(near.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], [*batch.schema.names, "cell", "angle"])

    kind = first.schema["kind"].dataType.simpleString()
    plain = first.select("id", "copies", "kind", "h1", "embedding")
    return stored(plain.mapInArrow(run, f"id long, copies long, kind {kind}, h1 long, embedding {first.schema['embedding'].dataType.simpleString()}, cell int, angle double"), "cells")


def _borders(cells: DataFrame, pivots: dict[tuple, np.ndarray], least: float) -> DataFrame:
    """Add the cells, its own among them, that may hold a vector within the angle of the threshold."""
    radius: dict[tuple, np.ndarray] = {kind: np.zeros(len(rows)) for kind, rows in pivots.items()}
    sized = cells.where(F.col("angle") > 0).groupBy("kind", "cell").agg(F.max("angle").alias("radius"))
    if pivots:  # a row for each pivot at most
        for row in sized.collect():
            radius[tuple(row["kind"])][row["cell"]] = row["radius"]
    shared = cells.sparkSession.sparkContext.broadcast((pivots, radius))
    angle, sine = math.acos(least), math.sqrt(1 - least * least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radius = shared.value
        for batch in batches:
            own = batch.column("cell").to_numpy()
            reach: list[list[int]] = [[int(c)] for c in own]
            embeddings = batch.column("embedding")
            for kind, rows in _by_kind(batch):
                if kind in pivots:
                    p = pivots[kind]
                    near = _unit(embeddings.take(pa.array(rows)).to_pylist()) @ p.T
                    mine = own[rows]
                    in_ball = np.arccos(np.clip(near, -1, 1)) <= radius[kind][None, :] + angle + SLACK
                    apart = np.sqrt(np.maximum(0, 2 - 2 * np.clip(p @ p.T, -1, 1)))[mine]
                    at_border = near[np.arange(len(rows)), mine][:, None] - near <= sine * apart + SLACK
                    for row, cells in zip(rows, in_ball & at_border, strict=True):
                        reach[row] = sorted({*np.flatnonzero(cells).tolist(), *reach[row]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach, pa.list_(pa.int32()))], [*batch.schema.names, "reach"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    return cells.mapInArrow(run, f"{fields}, reach array<int>")


def _joined(spread: DataFrame, least: float) -> DataFrame:
    """Join every part: its own vectors come first and are held, those copied to it pass by in blocks.

    Gives rows ``id, links, other``: how many vectors an id has been found to link with, and links enough to connect
    what the part has connected, at most one for each vector and block.
    """
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def rows(found: dict[int, int], edges: list[tuple[int, int]]) -> pa.RecordBatch:
        ids = [*found, *(a for a, _ in edges)]
        links = [*found.values(), *(0 for _ in edges)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array([*([None] * len(found)), *(b for _, b in edges)], pa.int64())], schema=schema)

    def compare(held: list, block: list, same: bool) -> pa.RecordBatch | None:
        """Links between the held vectors and a block, or among the held ones."""
        near = _unit([h[2] for h in held]) @ _unit([b[2] for b in block]).T >= least
        if same:
            np.fill_diagonal(near, False)
        if not near.any():
            return None
        copies = np.array([h[1] for h in held]), np.array([b[1] for b in block])
        found: dict[int, int] = {}
        for ids, n in ((held, near @ copies[1]), *(() if same else ((block, copies[0] @ near),))):
            for at in np.flatnonzero(n):
                found[ids[at][0]] = found.get(ids[at][0], 0) + int(n[at])
        return rows(found, _spanning(near, [h[0] for h in held], [b[0] for b in block]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, block, joined = None, [], [], True

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal joined, block
            if not joined:
                joined = True
                for at in range(0, len(held), PART_ROWS):  # a part that came out larger is joined in blocks as well
                    for to in range(at, len(held), PART_ROWS):
                        out = compare(held[at : at + PART_ROWS], held[to : to + PART_ROWS], at == to)
                        if out:
                            yield out
            for at in range(0, len(held) if block else 0, PART_ROWS):
                out = compare(held[at : at + PART_ROWS], block, False)
                if out:
                    yield out
            block = []

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "copied", "id", "copies", "embedding"))
            for key, copied, *vector in zip(*columns, strict=True):
                if key != part:
                    yield from flush()
                    part, held, joined = key, [], False
                if copied:
                    block.append(vector)
                    if len(block) >= BLOCK_ROWS:
                        yield from flush()
                else:
                    held.append(vector)
        yield from flush()

    return spread.mapInArrow(run, "id long, links long, other long")


def _spanning(near: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Links of the smallest id of each component to its other members: the components of a block of links."""
    rows, columns = near.nonzero()
    ids, place = np.unique(np.concatenate([np.array(left)[rows], np.array(right)[columns]]), return_inverse=True)
    a, b = place[: len(rows)], place[len(rows) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = np.minimum(after, after[after])
        if (after == root).all():
            break
        root = after
    return [(int(ids[i]), int(ids[root[i]])) for i in np.flatnonzero(root != np.arange(len(ids)))]


def near_duplicates(spark: SparkSession, vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """One row per row of ``vec_id``, ``label`` and ``embedding``: its links, its component, and whether it is kept.

    Vectors of the same label and length link if the cosine of their angle, in double precision, is at least ``least``
    (more than 0).  A component's id is the smallest ``vec_id`` in it; a null one is never the smallest.  A null label links with nothing, nor does an embedding that is null, empty, all zeros or holds a null
    or a number that is not finite; such a row is a component of its own.  Copies of a vector are joined as one and then
    counted; rows that repeat a ``vec_id`` count as vectors of their own.  Other columns are ignored.
    """
    first, rows = _distinct(vectors)
    pivots = _pivots(first)
    cells = _cells(first, pivots)
    # Stored, as are other sums below, so that joins have shuffles of their own in which Spark splits what is too large.
    sizes = stored(cells.groupBy("kind", "cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts")), "cell-sizes")
    reach = _borders(cells, pivots, least).withColumn("to", F.explode("reach"))
    own = F.col("cell") == F.col("to")
    sized = reach.join(sizes.withColumnRenamed("cell", "to"), ["kind", "to"]).join(sizes.withColumnRenamed("parts", "own_parts"), ["kind", "cell"])
    mine = F.pmod(F.col("h1"), F.col("own_parts"))
    spread = sized.withColumn("no", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Two parts meet once: copies go from one to the other by a rule that leaves each with about half of the others.
    at, to = F.struct(F.col("cell"), mine.cast("int").alias("no")), F.struct(F.col("to"), F.col("no"))
    odd = F.pmod(F.col("cell") + mine + F.col("to") + F.col("no"), F.lit(2)) == 1
    home = own & (mine == F.col("no"))
    goes = home | (F.when(odd, at < to).otherwise(at > to) & ~home)
    part = F.struct("kind", "to", "no").alias("part")
    sent = spread.where(goes).select(part, (~home).alias("copied"), "id", "copies", "embedding")
    grouped = sent.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortWithinPartitions("part", "copied")
    found = stored(_joined(grouped, least), "links")
    roots = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")), "vectors")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_first = first.select("h1", "h2", "id", "vec_id", "copies").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    of_first = of_first.withColumn("root", F.coalesce("root", "id"))
    heads = stored(of_first.groupBy("root").agg(F.min("vec_id").alias("component_id")), "vector-heads")
    answer = of_first.join(heads, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.join(answer, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    others = vectors.where(~_valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(others).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
