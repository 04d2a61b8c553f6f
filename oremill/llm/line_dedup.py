"""Line dedup: repeated runs of lines, found by a suffix array over sequences of line ids.

Every document is the sequence of its lines that are not blank.  Prefix doubling sorts the suffixes of all sequences:
they are ranked by their first line, then, with the rank of the suffix that starts where the first half ends, by their
first 2, 4, 8 ... lines.  Ranks keep the order of the suffixes, so that suffixes of equal rank stand together: they are
the intervals of the suffix array whose longest common prefix has at least so many lines.  An interval of one suffix is
dropped, for nothing that begins there is repeated; in most texts few suffixes survive the second round.

A run of lines is repeated if it also begins earlier, in document order.  It is deleted if it is long enough, counted in
characters.  Whatever its length, it is covered by windows that are just long enough: from each line the fewest lines,
forwards or backwards, that have ``MIN_CHARS`` characters.  Such a window has at most ``MIN_CHARS`` lines, so the doubling
ends at that depth, and a window of m lines lies in the interval named by the ranks, at the largest power of two, of its
first and its last lines.  The lines of all windows that begin earlier elsewhere make up the maximal repeated runs.

All of it is DataFrame code on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oremill.llm.common import stored, wide_hash

#: A repeated run is deleted if its lines have so many characters together.
MIN_CHARS = 20

_DOC = ["known", "id", "at"]


def _document(text: str) -> list[Column]:
    """A key of documents without nulls, in document order: null ids first, and a hash of the text for equal ids."""
    return [F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64(F.col(text)).alias("at")]


def _lines(documents: DataFrame, text: str) -> DataFrame:
    """The lines that are not blank: their document, place among these, place in the text, id and characters."""
    every = F.transform(F.split(F.col(text), "\n"), lambda line, n: F.struct(n.alias("line"), F.trim(line).alias("body")))
    # The key is worked out before the explosion: after it Spark would hash the whole text for each of its lines.
    keyed = documents.select(*_document(text), F.filter(every, lambda s: s["body"] != "").alias("every"))
    lines = keyed.select(*_DOC, F.posexplode("every").alias("pos", "s"))
    h1, h2 = wide_hash(F.col("s.body"))
    return lines.select(*_DOC, "pos", F.col("s.line").alias("line"), h1.alias("h1"), h2.alias("h2"), F.length("s.body").alias("chars"))


def _ranked(pairs: DataFrame, first: str, second: str, label: str) -> DataFrame:
    """A rank for every pair that occurs more than once, in the order of the pairs.

    Pairs are counted before they are shuffled, then sorted over all tasks; ids that grow along the sorted partitions are
    their ranks.  They are stored, as a second sort could cut the partitions elsewhere.
    """
    repeated = pairs.groupBy(first, second).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(repeated.orderBy(first, second).select(first, second, F.monotonically_increasing_id().alias("rank")), label)


def _windows(places: DataFrame, min_chars: int) -> DataFrame:
    """The windows just long enough, forwards and backwards from each line: first place and number of lines."""
    if min_chars <= 1:
        return places.select(*_DOC, F.col("pos").alias("first"), F.lit(1).alias("lines"))
    near = Window.partitionBy(*_DOC).orderBy("pos")
    line = F.struct("pos", "chars")
    ahead = F.collect_list(line).over(near.rangeBetween(0, min_chars - 1))
    behind = F.reverse(F.collect_list(line).over(near.rangeBetween(-(min_chars - 1), 0)))
    long = F.col("chars") >= min_chars

    def enough(lines: Column, step: int) -> Column:
        """How many lines from the first on have enough characters; null if a line that is not repeated comes before."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars"), F.lit(True).alias("whole"))

        def add(state: Column, one: Column) -> Column:
            following = state["whole"] & (one["pos"] == F.col("pos") + step * state["n"])
            going = F.struct((state["n"] + 1).alias("n"), (state["chars"] + one["chars"]).alias("chars"), F.lit(True).alias("whole"))
            broken = F.struct(state["n"].alias("n"), state["chars"].alias("chars"), F.lit(False).alias("whole"))
            return F.when(state["chars"] >= min_chars, state).when(following, going).otherwise(broken)

        return F.when(long, 1).otherwise(F.aggregate(lines, start, add, lambda s: F.when(s["chars"] >= min_chars, s["n"])))

    # A place next to long lines only needs no lists, but all windows over a document come from one sort.
    found = places.select(*_DOC, "pos", "chars", ahead.alias("ahead"), behind.alias("behind"))
    both = found.select(*_DOC, "pos", long.alias("long"), enough(F.col("ahead"), 1).alias("f"), enough(F.col("behind"), -1).alias("b"))
    forwards = both.where("f IS NOT NULL").select(*_DOC, F.col("pos").alias("first"), F.col("f").alias("lines"))
    backwards = both.where("b IS NOT NULL AND NOT long").select(*_DOC, (F.col("pos") - F.col("b") + 1).alias("first"), F.col("b").alias("lines"))
    return forwards.unionByName(backwards)


def _deleted(documents: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Of each document with later copies of repeated runs: ``gone``, the places in the text of their lines."""
    lines = _lines(documents, text)
    ids = _ranked(lines, "h1", "h2", "line-ranks")
    placed = lines.join(ids, ["h1", "h2"]).select(*_DOC, "pos", "line", "chars", "rank")
    # Rows that repeat a document's id and text are one document.
    places = stored(placed.repartition(*_DOC).dropDuplicates([*_DOC, "pos"]), "line-places")
    windows = stored(_windows(places, min_chars).distinct(), "line-windows")
    level, depth = places.select(*_DOC, "pos", "rank"), 1
    named = windows.where("lines = 1").join(level.withColumnRenamed("pos", "first"), [*_DOC, "first"])
    named = named.select(*_DOC, "first", "lines", F.col("rank").alias("a"), F.col("rank").alias("b"))
    longest = windows.agg(F.max("lines")).first()[0] or 1
    while 2 * depth <= longest:
        following = F.max("rank").over(Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(depth, depth))
        pairs = stored(level.withColumn("b", following).where("b IS NOT NULL").withColumnRenamed("rank", "a"), "line-pairs")
        depth *= 2
        level = stored(pairs.join(_ranked(pairs, "a", "b", "line-ranks"), ["a", "b"]).select(*_DOC, "pos", "rank"), "line-level")
        here = windows.where((F.col("lines") >= depth) & (F.col("lines") < 2 * depth)).withColumn("pos", F.col("first") + F.col("lines") - depth)
        ends = here.join(level.withColumnRenamed("rank", "b"), [*_DOC, "pos"]).drop("pos")
        both = ends.join(level.select(*_DOC, F.col("pos").alias("first"), F.col("rank").alias("a")), [*_DOC, "first"])
        named = named.unionByName(both.select(*_DOC, "first", "lines", "a", "b"))
    named = stored(named, "line-intervals")
    place = F.struct(*_DOC, F.col("first").alias("first"))
    earliest = named.groupBy("lines", "a", "b").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that the join has a shuffle of its own in which Spark can split an interval of very many suffixes.
    earliest = stored(earliest, "line-earliest")
    later = named.join(earliest, ["lines", "a", "b"]).where(F.col("earliest") < place)
    covered = later.select(*_DOC, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lines") - 1)).alias("pos"))
    gone = covered.distinct().join(places.select(*_DOC, "pos", "line"), [*_DOC, "pos"])
    return gone.groupBy(*_DOC).agg(F.collect_set("line").alias("gone"))


def _left_of(lines: Column) -> Column:
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    return F.transform(places, lambda n: F.get(lines, n))


def dedup(spark: SparkSession, df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Delete the later copies of repeated line runs from a text column; needs ``doc_id``.

    Lines are compared without blanks at their ends; blank lines neither count nor part a run, and stay.  The first copy,
    by ``doc_id`` (null first), then by a hash of the text, then by line, stays as well.  Copies may overlap: of a line
    repeated ten times in a row one stays.  Null and empty texts stay as they are, and rows that repeat an id and a text
    are one document, treated alike.  Adds ``n_lines`` (not blank) and ``n_deleted``, replacing columns of these names and
    of ``gone``, ``known``, ``id`` and ``at``; others pass through.
    """
    rest = [c for c in df.columns if c not in ("n_lines", "n_deleted", "gone", *_DOC)]
    rows = df.select(*rest, *_document(text))
    joined = rows.join(_deleted(df.select("doc_id", text), text, min_chars), _DOC, "left")
    lines = F.split(F.col(text), "\n")
    # The lines are bound once, and places looked up by hash: a text takes time in proportion to its lines.
    left = F.transform(F.array(lines), lambda all_lines: F.array_join(_left_of(all_lines), "\n"))[0]
    counted = F.size(F.filter(lines, lambda line: F.trim(line) != ""))
    return joined.select(
        *[F.when(F.col("gone").isNull(), F.col(c)).otherwise(left).alias(c) if c == text else F.col(c) for c in rest],
        F.when(F.col(text).isNull(), 0).otherwise(counted).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
    )


def deduped(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document: what is left of its text, its lines and how many of them were deleted."""
    return dedup(spark, documents.select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_deleted")
