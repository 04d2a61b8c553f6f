"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string, BPE's encoding ends in exactly one token.  Knowing that token for all shorter
prefixes, the last token of the next prefix is the one that (a) is a suffix of it and (b) may stand behind the last
token of what remains, that is, BPE encodes the two tokens' bytes as just these two.  So a table of one token per prefix
holds the encodings of all prefixes: bytes are appended by continuing it, and an edit is re-encoded from its start until
the table agrees with the old one again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oremill.llm.common import blocks, released
from oremill.llm.pretokens import split

#: Token pairs remembered by each Python worker: a full memory is emptied.  Pre-tokens are remembered in two halves of so many
#: each; when the newer one is full it becomes the older one, and what was not met in the meantime is forgotten.
REMEMBERED, PIECES = 150_000, 200_000
#: Longer pre-tokens, in characters, are not remembered.
LONGEST_PIECE = 256


class Vocabulary:
    """The ranks of a vocabulary file, with what the prefix table needs of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # A token that BPE makes of its own bytes is put together from two parts in its last merge.
        self.parts = {rank: self._last_merge(token) for token, rank in ranks.items()}
        self.suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1 or self.parts[rank]:
                self.suffixes.add_word(token.decode("latin-1"), (rank, len(token)))
        self.suffixes.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves the bytes of the two tokens as these two tokens.

        Undo their merges, latest first, looking only at the parts that touch.  Where two touching parts make a token
        of lower rank than the merge undone last, BPE would have joined them across the border before that merge.
        Of merges of the same rank the leftmost comes first.
        """
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= 2 * REMEMBERED:
                self._pairs.clear()
            known = self._pairs[key] = self._touch(left, right)
        return known

    def _touch(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            left_parts, right_parts = self.parts[left], self.parts[right]
            if left_parts and (left > right or not right_parts):
                before, left = left, left_parts[1]
            elif right_parts:
                before, right = right + 1, right_parts[0]
            else:
                return True

    def piece(self, piece: str) -> tuple[int, ...]:
        """The tokens of one pre-token."""
        known = self._pieces.get(piece)
        if known is None:
            known = self._older.get(piece)
            if len(self._pieces) >= PIECES:  # those that were not met since the last time are forgotten
                self._older, self._pieces = self._pieces, {}
            if known is not None:
                self._pieces[piece] = known
                return known
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None and (len(data) == 1 or self.parts[whole]):
                known = (whole,)
            else:
                known = tuple(PrefixTable(self, data).tokens())
            if len(piece) <= LONGEST_PIECE:
                self._pieces[piece] = known
        return known

    def encode(self, text: str) -> Iterator[int]:
        pieces = split(text)
        found = list(map(self._pieces.get, pieces))
        if None in found:
            found = [self.piece(piece) if known is None else known for piece, known in zip(pieces, found, strict=True)]
        return chain.from_iterable(found)

    def decode(self, tokens: Iterator[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, tokens))


def _ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file, read once by each process."""
    return Vocabulary(_ranks(path))


@lru_cache(maxsize=1)
def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of each token: all that decoding needs."""
    return {rank: token for token, rank in _ranks(path).items()}


class PrefixTable:
    """The last token of every prefix of a byte string, which is one pre-token or part of one."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Continue the table; what it holds stays as it is."""
        start, self.data = len(self.data), self.data + more
        self._fill(start)

    def _fill(self, start: int, old: list[int] | None = None, since: int = 0) -> None:
        """Fill in the prefixes longer than ``start``.  ``old`` are last tokens of a former string whose bytes are the same
        from ``since`` on: once as many entries as the longest token has bytes are the same, so are all others."""
        last, vocab = self.last, self.vocabulary
        pairs, follows = vocab._pairs, vocab.follows
        window = self.data[max(0, start - vocab.longest + 1) :].decode("latin-1")
        offset, here, same = len(self.data) - len(window) + 1, start, 0
        for end, (token, size) in vocab.suffixes.iter(window):
            end += offset
            if end <= here:  # found, or before the part to fill
                continue
            if end > size:
                left = last[end - size]
                fits = pairs.get(left << 32 | token)
                if fits is None:
                    fits = follows(left, token)
                if not fits:
                    continue
            last.append(token)
            here = end
            if old and end > since:
                same = same + 1 if old[end] == token else 0
                if same >= vocab.longest:
                    last.extend(old[end + 1 :])
                    return

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace the bytes from ``start`` to ``end``; re-encodes from there until the table agrees with the old one."""
        old = self.last
        shift = len(new) - (end - start)
        aligned = old[-shift:] if shift < 0 else [-1] * shift + old
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        self._fill(start, aligned, start + len(new))

    def tokens(self) -> list[int]:
        """The encoding of all of the bytes, read backwards from the last token."""
        found, at, sizes = [], len(self.data), self.vocabulary.sizes
        while at:
            token = self.last[at]
            found.append(token)
            at -= sizes[token]
        return found[::-1]


class EditableText:
    """A text with its pre-tokens' prefix tables: appends and edits re-encode only the pre-tokens they touch."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, ""
        self.tables: list[PrefixTable] = []
        self.starts: list[int] = []  # of the pre-tokens, in code points
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the code points from ``start`` to ``end``.

        A match of the pattern depends on its own characters and at most two behind it, so matches that end two
        characters before the edit stay.  Matching goes on from there until a match starts where one started before.
        """
        keep = int(np.searchsorted(self.starts, start - 2, side="right")) - 1 if self.starts else 0
        keep = max(keep, 0)
        since = self.starts[keep] if self.starts else 0
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        behind = {s + shift: i for i, s in enumerate(self.starts) if s >= end}
        old_tables, old_starts = self.tables, self.starts
        self.tables, self.starts = old_tables[:keep], old_starts[:keep]
        at, rest = since, split(self.text[since:])
        for i, piece in enumerate(rest):
            if at in behind and at >= start + len(new):
                same = behind[at]
                self.tables += old_tables[same:]
                self.starts += [s + shift for s in old_starts[same:]]
                return
            data = piece.encode()
            if i == 0 and keep < len(old_tables) and data.startswith(old_tables[keep].data):
                table = old_tables[keep]  # the last pre-token has grown
                table.append(data[len(table.data) :])
            else:
                table = PrefixTable(self.vocabulary, data)
            self.tables.append(table)
            self.starts.append(at)
            at += len(piece)

    def tokens(self) -> list[int]:
        return [token for table in self.tables for token in table.tokens()]


def encode(df: DataFrame, vocab_path: str, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """Add the tokens of a text column as ``array<int>``.

    Every whole text is encoded, without special tokens; null and empty texts have no tokens.  Rows are independent, so
    repeated rows, ties and skew do not matter, and nothing is shuffled.  A column named ``tokens`` is replaced, all
    others pass through.
    """
    keep = [c for c in df.columns if c != tokens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for block in blocks(batches, text):
            lists = [np.fromiter(vocab.encode(t), np.int32) if t else _NOTHING for t in block.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            values = pa.array(np.concatenate(lists) if lists else _NOTHING, pa.int32())
            yield pa.RecordBatch.from_arrays([*block.columns, pa.ListArray.from_arrays(ends, values)], [*keep, tokens])

    return df.select(*keep).mapInArrow(released(run), _and(df.select(*keep), f"`{tokens}` array<int>"))


def decode(df: DataFrame, vocab_path: str, tokens: str = "tokens", data: str = "data") -> DataFrame:
    """Add the bytes of a column of tokens as ``binary``; null and empty lists give no bytes.

    An unknown token is an error.  A column named ``data`` is replaced, all others pass through.
    """
    keep = [c for c in df.columns if c != data]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_bytes(vocab_path).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                found = [b"".join(map(known, ids.values.to_numpy().tolist())) if ids.is_valid else b"" for ids in part.column(tokens)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*keep, data])

    return df.select(*keep).mapInArrow(released(run), _and(df.select(*keep), f"`{data}` binary"))


def round_trip(df: DataFrame, vocab_path: str, text: str = "text", tokens: str = "tokens", data: str = "data") -> DataFrame:
    """Add the tokens of a text column, and the bytes that they decode to, in one pass; rows and columns as in
    :func:`encode` and :func:`decode`."""
    keep = [c for c in df.columns if c not in (tokens, data)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for block in blocks(batches, text):
            lists = [list(vocab.encode(t)) if t else [] for t in block.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            values = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
            columns = [pa.ListArray.from_arrays(ends, pa.array(values)), pa.array([vocab.decode(ids) for ids in lists], pa.binary())]
            yield pa.RecordBatch.from_arrays([*block.columns, *columns], [*keep, tokens, data])

    return df.select(*keep).mapInArrow(released(run), _and(df.select(*keep), f"`{tokens}` array<int>, `{data}` binary"))


_NOTHING = np.empty(0, np.int32)
_ROWS = 500


def _and(df: DataFrame, column: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), column])


def digests(documents: DataFrame, vocab_path: str) -> DataFrame:
    """One row per document: the number of tokens, and SHA-256 of the tokens and of the bytes they decode to."""
    coded = round_trip(documents.select("doc_id", "text"), vocab_path)
    return coded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
