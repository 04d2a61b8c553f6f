"""Token counts with the whole-token shortcut.

Most pre-tokens of running text are in the vocabulary as they stand.  That alone does not make them one token: merges
could stop short of the whole string.  So it is proved once for every string of the vocabulary that its own merges end
in one token.  Pre-tokens among those count one without any work; only the others are merged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oremill.llm.common import blocks
from oremill.llm.pretokens import split

#: Merged pre-tokens remembered by each Python worker, and the longest of them; a full memory is emptied.
REMEMBERED, REMEMBERED_CHARS = 150_000, 200


def _letters() -> list[str]:
    """The character by which vocabulary files write each byte: printable ones by themselves, others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Counter:
    """Counts of one vocabulary file of the kind byte-level BPE."""

    def __init__(self, spec: dict):
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"] or not before["use_regex"] or before["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normalizer is counted")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: at for at, pair in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.letters = _letters()
        self.whole = frozenset(self._provable(model["vocab"]))
        self._merged: dict[str, int] = {}

    def _provable(self, vocab: dict[str, int]) -> Iterator[str]:
        """The vocabulary strings, as text, whose merges end in one token.  Bytes that are no text are never a pre-token."""
        byte_of = {letter: b for b, letter in enumerate(self.letters)}
        for token in vocab:
            if all(c in byte_of for c in token) and self._merge(list(token)) == 1:
                try:
                    yield bytes(map(byte_of.__getitem__, token)).decode()
                except UnicodeDecodeError:
                    pass

    def _merge(self, parts: list[str]) -> int:
        """The number of tokens after all merges, lowest rank first and, of one rank, from the left.

        Pairs wait in a heap, parts are linked to their neighbours: a pre-token of n letters takes n log n steps.
        """
        rank, left = self.rank, len(parts)
        after, before = list(range(1, left + 1)), list(range(-1, left - 1))
        waiting = [(r, at) for at, pair in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank.get(pair)) is not None]
        heapify(waiting)
        while waiting:
            r, at = heappop(waiting)
            then = after[at]
            # Merges have changed some pairs since: a part merged to its left is empty.
            if then >= len(parts) or rank.get((parts[at], parts[then])) != r:
                continue
            parts[at] += parts[then]
            parts[then] = ""
            left -= 1
            after[at] = further = after[then]
            if further < len(parts):
                before[further] = at
                if (r := rank.get((parts[at], parts[further]))) is not None:
                    heappush(waiting, (r, at))
            if (earlier := before[at]) >= 0 and (r := rank.get((parts[earlier], parts[at]))) is not None:
                heappush(waiting, (r, earlier))
        return left

    def piece(self, piece: str) -> int:
        """The tokens of one pre-token."""
        if piece in self.whole:
            return 1
        known = self._merged.get(piece)
        if known is None:
            known = self._merge([self.letters[b] for b in piece.encode()])
            if len(piece) <= REMEMBERED_CHARS:
                if len(self._merged) >= REMEMBERED:
                    self._merged.clear()
                self._merged[piece] = known
        return known

    def _ordinary(self, text: str) -> int:
        pieces = split(text)
        rest = [p for p in pieces if p not in self.whole]
        return len(pieces) - len(rest) + sum(map(self.piece, rest))

    def count(self, text: str) -> int:
        """The tokens of a text; each special string inside it is one token, as the library has it by default."""
        parts, special = [text], 0
        for string in self.special:
            cut = [part.split(string) for part in parts]
            special += sum(len(c) - 1 for c in cut)
            parts = [p for c in cut for p in c]
        return special + sum(map(self._ordinary, parts))


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """The counter of a vocabulary file, proved once by each process."""
    with open(path, encoding="utf-8") as file:
        return Counter(json.load(file))


def count(df: DataFrame, vocab_path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of a text column as ``long``.

    Every whole text is counted; null and empty texts have none.  Rows are independent, so repeated rows, ties and skew
    do not matter, and nothing is shuffled.  A column named ``n_tokens`` is replaced, all others pass through.
    """
    keep = [c for c in df.columns if c != n_tokens]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields), f"`{n_tokens}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counter(vocab_path)
        for block in blocks(batches, text):
            counts = [found.count(t) if t else 0 for t in block.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(counts, pa.int64())], [*keep, n_tokens])

    return df.select(*keep).mapInArrow(run, fields)


def limits(documents: DataFrame, vocab_path: str, most: int = 1024) -> DataFrame:
    """One row per document: bytes, tokens, and whether it has more tokens than ``most``."""
    sized = documents.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = count(sized, vocab_path)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > most).alias("over_limit"))
