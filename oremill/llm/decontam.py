"""Benchmark decontamination: BM25 retrieval with block-max WAND, then verification.

The test items are an inverted index whose terms are pairs of neighbouring words.  A posting holds the share that the
term has in its item's own BM25 score, so a passage's score for an item is between 0 and 1, and one threshold holds for
all items.  Every passage of every document is a query; all items at or above the threshold are retrieved.  A retrieved
item counts as leaked if the passage also has its question and its answer, as runs of five words.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import blocks, released, stored

K1, B = 1.2, 0.75
#: Items are retrieved from this share of their own score on.
LEAST_SCORE = 0.4
#: Words of a run that both texts have; the part of the question's and the answer's words that such runs cover.
RUN_WORDS, LEAST_QUESTION, LEAST_ANSWER = 5, 0.8, 0.5
#: Without an answer of its own, an item's last quarter is its answer.
ANSWER_SHARE = 0.25
BLOCK_POSTINGS = 32
#: Items are searched in shards of so many words, each with a pass over the documents: the bound of what is broadcast.
SHARD_WORDS = 1_000_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass(frozen=True)
class Item:
    item_id: int | None
    question: tuple[str, ...]
    answer: tuple[str, ...]

    @property
    def words(self) -> tuple[str, ...]:
        return self.question + self.answer


def item(item_id: int | None, text: str | None, answer: str | None = None) -> Item:
    words = words_of(text)
    if answer and words_of(answer):
        return Item(item_id, tuple(words), tuple(words_of(answer)))
    cut = len(words) - max(1, round(len(words) * ANSWER_SHARE)) if words else 0
    return Item(item_id, tuple(words[:cut]), tuple(words[cut:]))


def terms_of(words: tuple[str, ...]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


class Index:
    """The inverted index of one shard, with the collection's statistics of all items."""

    def __init__(self, items: tuple[Item, ...], item_count: int, mean_terms: float, df: dict[tuple[str, str], int]):
        self.items = items
        self.longest = max(len(i.words) for i in items)
        postings: dict[tuple[str, str], list[tuple[int, float]]] = {}
        for at, one in enumerate(items):
            counts = terms_of(one.words)
            length = sum(counts.values()) / mean_terms
            weights = {
                t: math.log(1 + (item_count - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * length))
                for t, n in counts.items()
            }
            own = sum(weights.values())
            for t, w in weights.items():
                postings.setdefault(t, []).append((at, w / own))
        self.word_id = {w: n for n, w in enumerate(sorted({w for t in postings for w in t}))}
        v = len(self.word_id)
        ordered = sorted(postings, key=lambda t: self.word_id[t[0]] * v + self.word_id[t[1]])
        self.keys = np.array([self.word_id[a] * v + self.word_id[b] for a, b in ordered], np.int64)
        self.ids = [[i for i, _ in postings[t]] for t in ordered]
        self.weights = [[w for _, w in postings[t]] for t in ordered]
        self.most = np.array([max(w) for w in self.weights])
        # Of each block of a posting list: its last item, and the largest weight in it.
        cuts = [range(0, len(i), BLOCK_POSTINGS) for i in self.ids]
        self.block_last = [[i[min(c + BLOCK_POSTINGS, len(i)) - 1] for c in cut] for i, cut in zip(self.ids, cuts, strict=True)]
        self.block_most = [[max(w[c : c + BLOCK_POSTINGS]) for c in cut] for w, cut in zip(self.weights, cuts, strict=True)]

    def terms(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text where a term of the index stands, and which."""
        known = np.fromiter(map(self.word_id.get, words, repeat(-1)), np.int64, len(words))
        left, right = known[:-1], known[1:]
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[at] * len(self.word_id) + right[at]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[place] == keys
        return at[hit], place[hit]

    def search(self, terms: list[int], least: float = LEAST_SCORE) -> list[tuple[int, float]]:
        """All items whose score for a query of these different terms is at least ``least``: block-max WAND.

        The lists stand in the order of their next items.  The pivot is the first item at which the lists up to it could
        reach the threshold by their largest weights; if the blocks that hold it cannot, all are moved beyond the
        nearest end of a block.  Nothing is skipped that could reach the threshold.
        """
        lists = [[self.ids[t][0], 0, t] for t in terms]
        found = []
        least -= 1e-12  # for sums in another order
        while lists:
            lists.sort()
            reach = 0.0
            for pivot, (_, _, t) in enumerate(lists):
                reach += self.most[t]
                if reach >= least:
                    break
            else:
                break
            doc = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == doc:
                pivot += 1
            block_reach, ends = 0.0, []
            for _, _, t in lists[: pivot + 1]:
                block = bisect_left(self.block_last[t], doc)
                if block < len(self.block_last[t]):
                    block_reach += self.block_most[t][block]
                    ends.append(self.block_last[t][block])
            if block_reach >= least:
                if lists[0][0] == doc:
                    score = sum(self.weights[t][at] for item_at, at, t in lists[: pivot + 1])
                    if score >= least:
                        found.append((doc, score))
                    target = doc + 1
                else:
                    target = doc
            else:
                following = lists[pivot + 1][0] if pivot + 1 < len(lists) else len(self.items)
                target = max(doc + 1 if lists[0][0] == doc else doc, min([*(e + 1 for e in ends), following]))
            moved = []
            for entry in lists[: pivot + 1]:
                if entry[0] < target:
                    ids = self.ids[entry[2]]
                    at = bisect_left(ids, target, entry[1])
                    if at == len(ids):
                        continue
                    entry[0], entry[1] = ids[at], at
                moved.append(entry)
            lists = moved + lists[pivot + 1 :]
        return found

    def leaks(self, text: str | None) -> list[tuple[int, int, float, float, float]]:
        """Of each leaked item: its place in the shard, the passage's first word, score, and both overlaps.

        Passages are twice as long as the longest item and begin every half, so a copy of an item is whole in one.
        """
        words = words_of(text)
        if len(words) < RUN_WORDS:
            return []
        at, terms = self.terms(words)
        if not len(at):
            return []
        step = max(self.longest, RUN_WORDS)
        best: dict[int, tuple] = {}
        # A place belongs to the passage that begins in its step and to the one before.
        passage = np.concatenate([at // step, at // step - 1])
        term, order = np.concatenate([terms, terms]), None
        inside = passage >= 0
        passage, term = passage[inside], term[inside]
        order = np.lexsort((term, passage))
        passage, term = passage[order], term[order]
        once = np.ones(len(term), bool)
        once[1:] = (passage[1:] != passage[:-1]) | (term[1:] != term[:-1])
        passage, term = passage[once], term[once]
        starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        able = np.add.reduceat(self.most[term], starts) >= LEAST_SCORE - 1e-9
        ends = np.append(starts[1:], len(term))
        for start, end in zip(starts[able], ends[able], strict=True):
            begin = int(passage[start]) * step
            part = None
            for place, score in self.search(term[start:end].tolist()):
                if part is None:
                    part = words[begin : begin + 2 * step]
                    runs = {tuple(part[i : i + RUN_WORDS]) for i in range(len(part) - RUN_WORDS + 1)}
                question, answer = _overlap(self.items[place], runs)
                if question >= LEAST_QUESTION and answer >= LEAST_ANSWER:
                    best[place] = max(best.get(place, (-1.0,)), (score, -begin, question, answer))
        return [(place, -begin, score, q, a) for place, (score, begin, q, a) in sorted(best.items())]


def _overlap(one: Item, runs: set[tuple[str, ...]]) -> tuple[float, float]:
    """The parts of the question's and of the answer's words that stand in a run of five words the passage has too."""
    words = one.words
    covered = [False] * len(words)
    for at in range(len(words) - RUN_WORDS + 1):
        if words[at : at + RUN_WORDS] in runs:
            covered[at : at + RUN_WORDS] = [True] * RUN_WORDS
    cut = len(one.question)
    share = lambda part: sum(part) / len(part) if part else 1.0
    return share(covered[:cut]), share(covered[cut:])


@lru_cache(maxsize=2)
def _index(items: tuple[Item, ...], item_count: int, mean_terms: float, df: tuple) -> Index:
    return Index(items, item_count, mean_terms, dict(df))


def shards(benchmark: DataFrame) -> Iterator[tuple]:
    """The items, a shard at a time, with the statistics of all of them.

    ``benchmark`` has ``item_id``, ``text`` and perhaps ``answer``.  Items of fewer than five words are left out: they
    cannot be told from ordinary prose.  Items are dealt to shards by a hash, so that a shard has about ``SHARD_WORDS``
    words; only one shard at a time is on the driver.
    """
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [item(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text", "answer")), strict=True)]
            rows = [
                {"item_id": i.item_id, "question": i.question, "answer": i.answer, "terms": ["\t".join(t) for t in terms_of(i.words)]}
                for i in each
                if len(i.words) >= RUN_WORDS
            ]
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item_id", pa.int64()), ("question", words), ("answer", words), ("terms", words)]))

    plain = benchmark.select(F.col("item_id").cast("long"), "text", answer.alias("answer"))
    items = stored(plain.mapInArrow(released(run), "item_id long, question array<string>, answer array<string>, terms array<string>"), "items")
    size = F.size("question") + F.size("answer")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("words"), F.avg(size - 1).alias("mean")).first()
    count = -(-(total["words"] or 0) // SHARD_WORDS)
    df = items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    number = F.pmod(F.xxhash64("item_id", "question"), F.lit(max(1, count)))
    for shard in range(count):
        own = items.where(number == shard)
        kept = df.join(own.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi").collect()
        rows = sorted(own.select("item_id", "question", "answer").collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["question"]))
        if rows:
            yield (
                tuple(Item(r["item_id"], tuple(r["question"]), tuple(r["answer"])) for r in rows),
                total["n"],
                total["mean"],
                tuple(sorted((tuple(r["term"].split("\t")), r["df"]) for r in kept)),
            )


LEAK = "array<struct<item_id:long,start:int,score:double,question:double,answer:double>>"


def leaks(spark: SparkSession, df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Add ``leaks``: the test items that a text contains, by item id.

    Each has the passage's first word, the score of retrieval and the covered parts of question and answer.  Whole
    texts are searched; null, empty and very short texts have no leaks, and an empty benchmark gives none.  Repeated
    items are found each.  Rows are independent, so repeats, ties and skew do not matter and nothing is shuffled.  A
    column named ``leaks`` is replaced, all others pass through.
    """
    found = df.select(*[c for c in df.columns if c != "leaks"], F.lit(None).cast(LEAK).alias("leaks"))
    rest = [c for c in found.columns if c != "leaks"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    number, real = pa.int64(), pa.float64()
    arrow = pa.list_(pa.struct([("item_id", number), ("start", pa.int32()), ("score", real), ("question", real), ("answer", real)]))
    for shard in shards(benchmark):
        shared = spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(*shared.value)
            for block in blocks(batches, text):
                lists = []
                for t, before in zip(block.column(text).to_pylist(), block.column("leaks").to_pylist(), strict=True):
                    now = [{"item_id": index.items[p].item_id, "start": at, "score": s, "question": q, "answer": a} for p, at, s, q, a in index.leaks(t)]
                    lists.append((before or []) + now)
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in rest), pa.array(lists, arrow)], [*rest, "leaks"])

        found = found.mapInArrow(released(run), fields)
    return found.withColumn("leaks", F.coalesce("leaks", F.array().cast(LEAK)))


def contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and test item that it contains."""
    found = leaks(spark, documents.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.inline("leaks")).withColumnsRenamed({"question": "question_overlap", "answer": "answer_overlap", "start": "passage_start"})
