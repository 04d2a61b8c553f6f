"""Language identification by compression.

A text is compressed with Zstandard once for each language, each time with a raw-content dictionary of prose in that
language.  The language whose dictionary makes it smallest has the most strings in common with it.  The size in bytes is
coarse, so short texts may tie; a tie goes to the language with more training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oremill.llm.common import blocks

#: Bounds of what is learned: rows of each language, bytes of a dictionary, and the pieces, spread over the whole of a text,
#: that stand for a longer one, with the characters of each.
SAMPLE_ROWS, DICTIONARY_BYTES, PIECES, PIECE_CHARS = 600, 250_000, 10, 300
#: Texts are compressed in pieces of so many bytes, so that the dictionary counts in long texts as it does in short ones.
PIECE_BYTES = 4_000
LEVEL = 5

UNDETERMINED = "und"
_NO_WORD = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Letters in lower case, with one blank for whatever stands between them."""
    return _NO_WORD.sub(" ", text.lower()).strip()


def _pieces(text: Column) -> Column:
    """A text, or of a long one ``PIECES`` pieces at even distances, the first at its beginning and the last at its end."""
    last = F.length(text) - PIECE_CHARS
    starts = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda n: (n * last / (PIECES - 1)).cast("int") + 1)
    return F.when(F.length(text) <= PIECES * PIECE_CHARS, text).otherwise(
        F.array_join(F.transform(starts, lambda start: F.substring(text, start, F.lit(PIECE_CHARS))), " ")
    )


def _evenly(parts: list[bytes], most: int) -> list[bytes]:
    """As much of each part as fits if all have the same share, where short ones leave theirs to the others."""
    room, share = most - len(parts), 0
    sizes = sorted(map(len, parts))
    for n, size in enumerate(sizes):
        share = max(0, room) // (len(sizes) - n)
        if size > share:
            break
        room -= size
        share = size
    return [_spread(part, share) for part in parts]


def _spread(part: bytes, most: int) -> bytes:
    """Pieces at even distances of a longer part."""
    if len(part) <= most:
        return part
    pieces = max(1, min(PIECES, most // 40))
    size = most // pieces
    starts = [n * (len(part) - size) // max(1, pieces - 1) for n in range(pieces)]
    return b"".join(part[at : at + size] for at in starts)


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """The dictionary of each language, the language with most rows first.

    Rows without text or language are left out.  Of each language the ``SAMPLE_ROWS`` different texts of smallest hash
    are used, whatever the partitioning; copies of a text count once, and only one hash per text is shuffled.  A long text
    gives pieces from its beginning to its end, and all texts of the sample share the dictionary evenly.

    Hashes are spread evenly, so only those below a bound taken from the counts are ranked: four times the sample, of a
    language of any size, which leaves too few with a probability far below 1e-100.
    """
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    keyed = known.withColumn("at", F.xxhash64("text"))
    texts = keyed.groupBy("lang", "at").agg(F.count(F.lit(1)).alias("n"))
    counts = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different")).collect()
    most = {r["lang"]: r["n"] for r in counts}
    bounds = [(r["lang"], min(2**63 - 1, -(2**63) + 2**64 * 4 * SAMPLE_ROWS // r["different"])) for r in counts]
    bound = rows.sparkSession.createDataFrame(bounds, "lang string, bound long")
    first = Window.partitionBy("lang").orderBy("at")
    near = texts.join(F.broadcast(bound), "lang").where("at <= bound")
    chosen = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_ROWS).select("lang", "at")
    # The join's small side has SAMPLE_ROWS rows a language.  Copies of a chosen text meet again in the aggregation.
    excerpts = (
        keyed.join(F.broadcast(chosen), ["lang", "at"], "left_semi")
        .select("lang", "at", _pieces(F.col("text")).alias("part"))
        .groupBy("lang", "at")
        .agg(F.min("part").alias("part"))
    )
    parts: dict[str, list[bytes]] = {name: [] for name in most}
    for row in sorted(excerpts.collect(), key=lambda r: (r["lang"], r["at"])):
        parts[row["lang"]].append(plain(row["part"]).encode())
    order = sorted(most, key=lambda name: (-most[name], name))
    return [(name, b"\n".join(_evenly(parts[name], DICTIONARY_BYTES))) for name in order]


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.names = [name for name, _ in dictionaries]
        self.compressors = [self._compressor(data) for _, data in dictionaries]

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if data else None
        if content:
            content.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """The language, a score, and the margin: by how much of the smallest size the second smallest is larger.

        The score is 1 over the sum of ``2 ** -(excess bytes)`` of all languages: 1 for a clear result, 1/n for n ties.
        """
        words = plain(text) if text else ""
        if not self.names or not any(map(str.isalpha, words)):
            return UNDETERMINED, 0.0, 0.0
        data = words.encode()
        pieces = [data[at : at + PIECE_BYTES] for at in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(c.compress(piece)) for piece in pieces) for c in self.compressors]
        best = min(sizes)
        score = 1 / sum(2.0 ** -min(size - best, 1000) for size in sizes)
        second = min((s for i, s in enumerate(sizes) if i != sizes.index(best)), default=2 * best)
        return self.names[sizes.index(best)], score, (second - best) / best


@lru_cache(maxsize=2)
def _classifier(dictionaries: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(list(dictionaries))


def classify(spark: SparkSession, df: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text", min_margin: float = 0.0) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``margin``; columns of these names are replaced, all others pass through.

    Whole texts are compressed.  A text that is null, empty or without a letter is ``und`` with score 0, and so is every
    text if nothing was learned.  A margin below ``min_margin`` is rejected: ``und``, the score kept.  Rows are
    independent: ties, repeats and skew do not matter.
    """
    names = ("lang_pred", "score", "margin")
    rest = df.select(*[c for c in df.columns if c not in names])
    learned = spark.sparkContext.broadcast(tuple(dictionaries))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), "lang_pred string, score double, margin double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _classifier(learned.value)
        for block in blocks(batches, text):
            found = [known.classify(t) for t in block.column(text).to_pylist()]
            langs = [UNDETERMINED if margin < min_margin else lang for lang, _, margin in found]
            arrays = [pa.array(langs, pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*block.columns, *arrays], [*block.schema.names, *names])

    return rest.mapInArrow(run, fields)


def fold(column: str, of: int) -> F.Column:
    """The remainder of CRC-32 of a number as text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


def predictions(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document; learned from the rows whose remainder by 4 is not 2.  A null id is never learned from."""
    rows = documents.select("doc_id", "text", "lang", fold("doc_id", 4).alias("part"))
    known = learn(rows.where("part != 2"))
    asked = rows.select("doc_id", "text", F.coalesce(F.col("part") == 2, F.lit(False)).alias("held_out"))
    return classify(spark, asked, known).select("doc_id", "held_out", "lang_pred", "score", "margin")
