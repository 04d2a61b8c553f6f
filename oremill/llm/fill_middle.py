"""Fill-in-the-middle: documents cut into prefix, middle and suffix, and put together in another order.

A document is cut into units, words with the blanks before them, and two cuts between units make three parts.  Parts are
emitted in pieces, chunks of whole units, keyed by the document's row and the place in the output.
``repartitionAndSortWithinPartitions`` deals pieces by row and sorts them by place, and an iterator streams each document's
pieces into a consumer, such as a digest that grows piece by piece.  So no part, and no output, is ever put together in
memory, unless the consumer does it.

Restoration reads the output as a stream, finds the marks in it, gives what stands between them its place in the text, and
sorts again by that.  Rows stay in the partition that they are in, so the second sort takes no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain, groupby, repeat

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Marks of the parts, blanks between units, and the shares of documents by hundredths.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
CHANGED, OF_THEM_SPM = 50, 80
SEED = "42"

#: Bytes of text for each partition of the sort, if that makes more partitions than a shuffle has.
PARTITION_BYTES = 64 << 20
#: Units of a piece, and bytes after which a piece ends within a unit.
PIECE_UNITS, PIECE_BYTES = 2048, 1 << 16

#: The marks and parts of the output, by form; parts are numbered as they stand in the text.
ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
_blank = np.zeros(256, bool)
_blank[list(BLANKS)] = True

#: A key is (row, place of the part, number of the piece); a document's head comes first.
Piece = tuple[tuple[int, int, int], object]


def unit_ends(data: bytes) -> np.ndarray:
    """Where units end in a text of UTF-8: blanks and what follows them up to the next blank, or blanks at the end."""
    blank = _blank[np.frombuffer(data, np.uint8)]
    if not len(blank):
        return np.empty(0, np.int64)
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(blank))


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four numbers that depend on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def plan(doc_id: int | None, data: bytes, ends: np.ndarray) -> tuple[str, int, int]:
    """The form of a document, and the bytes where its middle starts and ends."""
    h1, h2, h3, h4 = draws(doc_id)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CHANGED:
        return "plain", 0, 0
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    starts = np.concatenate(([0], ends))
    return "spm" if h4 % 100 < OF_THEM_SPM else "psm", int(starts[a]), int(starts[b])


def _chars(data: bytes) -> int:
    return int((np.frombuffer(data, np.uint8) & 0xC0 != 0x80).sum())


def _pieces(data: bytes, start: int, end: int, ends: np.ndarray) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end`` in chunks of whole units; a unit of very many bytes is cut between characters."""
    inside = ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, end, "left")]
    for stop in [*inside[PIECE_UNITS - 1 :: PIECE_UNITS].tolist(), end]:
        while stop - start > PIECE_BYTES:
            cut = start + PIECE_BYTES
            within = ends[np.searchsorted(ends, cut, "right") - 1] if ends[0] <= cut else 0
            if within > start:
                cut = int(within)
            else:
                while data[cut] & 0xC0 == 0x80:
                    cut -= 1
            yield data[start:cut]
            start = cut
        if stop > start:
            yield data[start:stop]
            start = stop


def _emitted(rows: Iterator) -> Iterator[Piece]:
    """Of each document a head, and the pieces of its output: marks and chunks of units, keyed by row and place."""
    for row, doc_id, text in rows:
        data = (text or "").encode()
        ends = unit_ends(data)
        form, start, end = plan(doc_id, data, ends)
        chars = (None, None) if form == "plain" else (_chars(data[:start]), _chars(data[start:end]))
        yield (row, -1, 0), (doc_id, len(ends), form, *chars)
        spans = ((0, start), (start, end), (end, len(data)))
        parts = [(b"", (0, len(data)))] if form == "plain" else [(mark, spans[part]) for mark, part in ORDER[form]]
        for place, (mark, span) in enumerate(parts):
            if mark:
                yield (row, place, 0), mark
            for number, piece in enumerate(_pieces(data, *span, ends)):
                yield (row, place, 1 + number), piece


def _deal(key: tuple[int, int, int]) -> int:
    return key[0] * 0x9E3779B97F4A7C15 % (1 << 63) >> 20


def _sorted(pieces: RDD, partitions: int) -> RDD:
    """Pieces dealt by row and sorted by place; those that are dealt so already stay where they are."""
    return pieces.repartitionAndSortWithinPartitions(partitions, _deal)


def assembled(documents: DataFrame, partitions: int | None = None) -> RDD:
    """The sorted pieces of the outputs: of each row of ``documents`` a head (``doc_id``, units, form, characters of prefix
    and middle, these null if plain) and then its output's bytes in order.

    A null text is empty.  A null id draws as empty text would, rows that repeat an id draw alike; every row is a document
    of its own.  ``documents`` should be a stored table: rows are told apart by where they stand.
    """
    if not partitions:
        size = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
        partitions = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return _sorted(rows.rdd.mapPartitions(_emitted), partitions)


class Marks:
    """Finds the marks of an output that comes in pieces, and tells which part of the text the bytes belong to.

    Every mark occurs once.  As many bytes as a mark may have begun in are held back until the next piece.
    """

    def __init__(self, form: str):
        self.left = list(ORDER.get(form, ()))
        self.part = 0
        self.held = b""

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        data, self.held = self.held + piece, b""
        while self.left:
            mark, part = self.left[0]
            at = data.find(mark)
            if at < 0:
                keep = 0 if last else min(len(mark) - 1, len(data))
                data, self.held = data[: len(data) - keep], data[len(data) - keep :]
                break
            if at:
                yield self.part, data[:at]
            data, self.part = data[at + len(mark) :], part
            self.left.pop(0)
        if data:
            yield self.part, data


def restored(outputs: RDD, seen: Callable | None = None) -> RDD:
    """The sorted pieces of the texts that sorted outputs were made of, from form and output alone.  Heads get one more
    value: the hex digest of the output's bytes, if ``seen`` makes a digest to be fed with them in order, else null."""

    def run(stream: Iterator[Piece]) -> Iterator[Piece]:
        for row, pieces in groupby(stream, key=lambda piece: piece[0][0]):
            head = next(pieces)[1]
            marks, number, consumer = Marks(head[2]), 0, seen() if seen else None
            for (_, piece), last in chain(zip(pieces, repeat(False)), [((None, b""), True)]):
                if consumer:
                    consumer.update(piece)
                for part, data in marks.feed(piece, last):
                    number += 1
                    yield (row, part, number), data
            yield (row, -1, 0), (*head, consumer.hexdigest() if consumer else None)

    partitions = outputs.getNumPartitions()
    return _sorted(outputs.mapPartitions(run, preservesPartitioning=True), partitions)


def transformed(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, the output as one text.

    As in :func:`assembled`; an empty table gives no rows, and other columns of ``documents`` are ignored.
    """

    def run(stream: Iterator[Piece]) -> Iterator[tuple]:
        for _, pieces in groupby(stream, key=lambda piece: piece[0][0]):
            head = next(pieces)[1]
            yield (*head, b"".join(piece for _, piece in pieces).decode())

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return spark.createDataFrame(assembled(documents).mapPartitions(run), schema, verifySchema=False)


def digests(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``: one row per document, digests made
    piece by piece, that of the text from what the output was restored to."""

    def run(stream: Iterator[Piece]) -> Iterator[tuple]:
        for _, pieces in groupby(stream, key=lambda piece: piece[0][0]):
            head, text = next(pieces)[1], hashlib.sha256()
            for _, piece in pieces:
                text.update(piece)
            yield (*head, text.hexdigest())

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return spark.createDataFrame(restored(assembled(documents), hashlib.sha256).mapPartitions(run), schema, verifySchema=False)
