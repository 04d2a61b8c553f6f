"""Toxicity: misspelled lexicon terms, weighed by their context.

The lexicon is learned: words, and beginnings of words, that labelled toxic texts have and clean ones do not.  It is
kept as a trie.  Words within a few edits of a term are found by running the Levenshtein automaton of the terms: its
states are sets of (trie node, edits used), made when first reached, so that a word costs one step a letter and most
words end in the dead state after two or three.  What surrounds a term tells quotation from abuse: quotation marks on
both sides, and the words that stand near terms in clean texts rather than in toxic ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import blocks, released, stored, words
from oremill.llm.lang_id import fold

#: A classifier is fitted on about so many labelled rows, picked by a hash of their id.
LABELLED_ROWS = 12_000
#: A term needs this log-likelihood ratio, and these odds of a word of a toxic text against one of a clean text.
LEAST_EVIDENCE, LEAST_ODDS = 20.0, 12.0
#: Of beginnings of words: lengths, and different words that they must begin.
STEM_LETTERS, STEM_WORDS = (4, 8), 3
#: Terms at most, those of most evidence first, and words of the context: bounds of the model's size.
MOST_TERMS, MOST_CONTEXT = 4_000, 4_000
#: A context has so many words on either side, and quotation marks count within so many characters.
WINDOW, QUOTED_WITHIN = 6, 60
#: What a term counts that is one or two edits away, and one in quotation marks.
EDIT_WEIGHT, QUOTED_WEIGHT = (1.0, 0.7, 0.45), 0.15
#: Python workers remember so many words; a full memory is emptied.
REMEMBERED = 150_000

_WORD = re.compile(r"[^\W_]+")
_OPENING, _CLOSING = "\"“„«‹‘»”", "\"”“»›’«"


def edits_allowed(term: str, stem: bool) -> int:
    """Short terms have too many neighbours that are ordinary words."""
    letters = len(term) - 2 * stem
    return 0 if letters < 5 else 1 if letters < 8 else 2


class Automaton:
    """The Levenshtein automaton of all terms at once, swapped neighbours counting as one edit."""

    def __init__(self, terms: dict[str, bool]):
        """terms: whether the term is the beginning of a word, and so may be followed by more letters."""
        self.children: list[dict[str, int]] = [{}]
        self.allowed, self.ends, self.open = [0], [-1], [-1]  # by node: edits of any term beyond it; of the term here
        for term, stem in terms.items():
            allowed, node = edits_allowed(term, stem), 0
            for letter in term:
                self.allowed[node] = max(self.allowed[node], allowed)
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.children):
                    for column, value in ((self.children, {}), (self.allowed, 0), (self.ends, -1), (self.open, -1)):
                        column.append(value)
            self.allowed[node] = max(self.allowed[node], allowed)
            (self.open if stem else self.ends)[node] = allowed
        self.start = self._closure({(0, 0, "")})
        self.steps: dict[frozenset, dict[str, frozenset]] = {}
        self.found: dict[frozenset, tuple[int, int]] = {}

    def _closure(self, state: set[tuple[int, int, str]]) -> frozenset:
        """With the nodes reached by leaving out letters of a term.  A third member is the letter owed by a swap."""
        todo = list(state)
        while todo:
            node, edits, owed = todo.pop()
            if not owed and edits < self.allowed[node]:
                for child in self.children[node].values():
                    if edits + 1 <= self.allowed[child] and (child, edits + 1, "") not in state:
                        state.add((child, edits + 1, ""))
                        todo.append((child, edits + 1, ""))
        return frozenset(state)

    def _step(self, state: frozenset, letter: str) -> frozenset:
        after: set[tuple[int, int, str]] = set()
        for node, edits, owed in state:
            if owed:
                if owed == letter:
                    after.add((node, edits, ""))
                continue
            for other, child in self.children[node].items():
                if other == letter:
                    after.add((child, edits, ""))
                elif edits < self.allowed[child]:
                    after.add((child, edits + 1, ""))
                    swapped = self.children[child].get(letter)
                    if swapped and edits < self.allowed[swapped]:
                        after.add((swapped, edits + 1, other))
            if edits < self.allowed[node]:
                after.add((node, edits + 1, ""))
        return self._closure(after)

    def _ends(self, state: frozenset) -> tuple[int, int]:
        """The fewest edits of a term, and of a beginning, that ends here; 9 for none."""
        here = [(edits, node) for node, edits, owed in state if not owed]
        return (
            min((e for e, node in here if e <= self.ends[node]), default=9),
            min((e for e, node in here if e <= self.open[node]), default=9),
        )

    def edits(self, word: str) -> int:
        """The edits between the word and the nearest term that allows so many; 9 if there is none."""
        state, best = self.start, 9
        for letter in word:
            steps = self.steps.setdefault(state, {})
            after = steps.get(letter)
            if after is None:
                after = steps[letter] = self._step(state, letter)
            if not after:
                return best
            state = after
            if state not in self.found:
                self.found[state] = self._ends(state)
            best = min(best, self.found[state][1])
        return min(best, self.found[state][0]) if word else 9


@dataclass(frozen=True)
class Model:
    """Plain values, so that it can be sent to executors."""

    terms: tuple[tuple[str, bool], ...] = ()
    ordinary: frozenset[str] = frozenset()  # words near a term that clean texts use
    context: tuple[tuple[str, float], ...] = ()  # log odds of a word near a term in clean rather than in toxic texts
    weights: tuple[float, ...] = (-4.0, 3.0, 1.0, 0.5)


class Scorer:
    def __init__(self, model: Model):
        self.automaton = Automaton(dict(model.terms))
        self.ordinary, self.context = model.ordinary, dict(model.context)
        self.weights = np.array(model.weights)
        self._known: dict[str, int] = {}

    def edits(self, word: str) -> int:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            known = 9 if word in self.ordinary else self.automaton.edits(word)
            self._known[word] = known
        return known

    def hits(self, text: str) -> list[tuple[int, int, int, bool, list[str]]]:
        """Of each term found: start, end, edits, whether it is quoted, and the words around it."""
        lowered = text.lower()
        found = _WORD.findall(lowered)
        known = list(map(self.edits, found))
        if min(known, default=9) == 9:
            return []
        spans = [m.span() for m in _WORD.finditer(lowered)]
        out = []
        for at, edits in enumerate(known):
            if edits < 9:
                start, end = spans[at]
                around = found[max(0, at - WINDOW) : at] + found[at + 1 : at + 1 + WINDOW]
                before = lowered[max(0, start - QUOTED_WITHIN) : start].rpartition("\n")[2]
                after = lowered[end : end + QUOTED_WITHIN].partition("\n")[0]
                out.append((start, end, edits, _quoted(before, after), around))
        return out

    def features(self, text: str | None) -> list[float]:
        """A constant, the weight of all terms, of the heaviest, and by the number of words."""
        found = self.hits(text) if text else []
        if not found:
            return [1.0, 0.0, 0.0, 0.0]
        weights = []
        for _, _, edits, quoted, around in found:
            lean = sum(self.context.get(w, 0.0) for w in around)  # above 0: as in clean texts
            weights.append(EDIT_WEIGHT[edits] * (QUOTED_WEIGHT if quoted else 1.0) / (1 + math.exp(min(max(lean - 3.0, -30), 30))))
        total = sum(weights)
        return [1.0, math.log1p(total), max(weights), math.log1p(100 * total / max(20, len(text) / 6))]

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-min(max(float(self.weights @ self.features(text)), -30), 30))))


def _quoted(before: str, after: str) -> bool:
    """Whether a quotation opened before the term, on its line, is still open there and closes behind it."""
    opened = max((before.rfind(q) for q in _OPENING), default=-1)
    if opened < 0 or not any(q in after for q in _CLOSING):
        return False
    mark = before[opened]
    return (before.count(mark) % 2 == 1 and after.count(mark) > 0) if mark == '"' else mark in "“„«‹‘"


@lru_cache(maxsize=1)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def learn(spark: SparkSession, documents: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Learn from the labels of the rows whose remainder by 5 is not 0.

    ``documents`` has ``doc_id`` and a text column, ``labels`` has ``doc_id`` and ``toxic``.  Null ids, labels and texts
    are left out; a document labelled more than once is toxic if one label says so.  About ``LABELLED_ROWS`` rows are
    used, all if there are fewer: that bounds the broadcast of their ids, and all that reaches the driver.  Without any
    toxic row the model finds nothing.
    """
    usable = labels.select("doc_id", "toxic").where((fold("doc_id", 5) != 0) & F.col("toxic").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, LABELLED_ROWS / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = documents.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
    return _learn(stored(rows.select("text", (F.col("toxic") == 1).alias("toxic")), "labelled"))


def _learn(rows: DataFrame) -> Model:
    # In toxic texts a word counts once for each pair of words around it that clean texts do not have around it, so that
    # copies and near copies of a toxic text add nothing; in clean texts every occurrence counts.
    body = rows.select("toxic", words(F.col("text")).alias("w")).select("toxic", F.posexplode("w").alias("at", "word"), "w")
    around = F.xxhash64(F.try_element_at("w", F.col("at")), F.col("word"), F.try_element_at("w", F.col("at") + 2))
    seen = body.select("toxic", "word", F.when(F.col("at") == 0, F.xxhash64("w")).otherwise(around).alias("around"))
    once = seen.groupBy("word", "around").agg(F.count_if(~F.col("toxic")).alias("c"))
    counts = stored(once.groupBy("word").agg(F.count_if(F.col("c") == 0).alias("t"), F.sum("c").alias("c")), "words")
    totals = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    n_toxic, n_clean = totals["t"] or 0, totals["c"] or 0
    if not n_toxic or not n_clean:
        return Model()
    lengths = F.sequence(F.lit(STEM_LETTERS[0]), F.least(F.length("word") - 1, F.lit(STEM_LETTERS[1])))
    begun = counts.where(F.length("word") > STEM_LETTERS[0]).withColumn("length", F.explode(lengths))
    stems = begun.groupBy(F.expr("left(word, length)").alias("word")).agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
    candidates = counts.where("t >= 2").select("word", "t", "c", F.lit(False).alias("stem")).unionByName(
        stems.where((F.col("n") >= STEM_WORDS) & (F.col("t") >= 4)).select("word", "t", "c", F.lit(True).alias("stem"))
    )
    odds = (F.col("t") + 0.2) / (n_toxic + 1) / ((F.col("c") + 0.2) / (n_clean + 1))
    all_toxic, both = F.lit(n_toxic / (n_toxic + n_clean)), F.col("t") + F.col("c")
    evidence = 2 * (
        F.col("t") * F.log(F.col("t") / (both * all_toxic))
        + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * (1 - all_toxic)))).otherwise(0.0)
    )
    strong = candidates.withColumn("evidence", evidence).where((odds >= LEAST_ODDS) & (F.col("evidence") >= LEAST_EVIDENCE))
    best = strong.orderBy(F.desc("evidence"), "word", "stem").limit(MOST_TERMS).collect()
    terms = _covering({(r["word"], r["stem"]): r["evidence"] for r in best})
    automaton = Automaton(dict(terms))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [automaton.edits(w) not in (0, 9) for w in batch.column("word").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # Words near a term that clean texts use as often as toxic ones are no misspellings.
    usual = counts.where((F.col("c") >= 1) & (F.col("c") * 3 * n_toxic >= F.col("t") * n_clean)).select("word")
    ordinary = frozenset(r["word"] for r in usual.mapInArrow(released(near), "word string").collect())
    found = Model(terms, ordinary)
    context = _context(rows, found)
    found = Model(terms, ordinary, context)
    fitted = scored(rows, found, "features").select("toxic", "features").collect()
    return Model(terms, ordinary, context, _fit(np.array([r["features"] for r in fitted]), np.array([r["toxic"] for r in fitted], float)))


def _covering(evidence: dict[tuple[str, bool], float]) -> tuple[tuple[str, bool], ...]:
    """The terms without those that a beginning of nearly the same evidence covers, and beginnings without longer ones."""
    kept: dict[str, bool] = {}
    for word, stem in sorted(evidence, key=lambda k: (len(k[0]), not k[1], k[0])):
        if not any(kept.get(word[:n]) for n in range(STEM_LETTERS[0], len(word) + (not stem))):
            kept[word] = kept.get(word, False) or stem
    return tuple(sorted(kept.items()))


def _context(rows: DataFrame, model: Model) -> tuple[tuple[str, float], ...]:
    """Log odds of the words that stand near terms in clean texts against those near terms in toxic ones."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for block in blocks(batches, "text"):
            near = [sorted({w for hit in scorer.hits(t) for w in hit[4]}) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("toxic"), pa.array(near, pa.list_(pa.string()))], ["toxic", "near"])

    found = rows.select("toxic", "text").mapInArrow(released(around), "toxic boolean, near array<string>").where(F.size("near") > 0)
    n = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return ()
    counts = found.select("toxic", F.explode("near").alias("word")).groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    lean = F.log((F.col("c") + 0.5) / (n[False] + 1.0)) - F.log((F.col("t") + 0.5) / (n[True] + 1.0))
    used = counts.where((F.col("c") >= 3) & (F.col("c") + F.col("t") >= 5)).withColumn("lean", F.greatest(F.lit(-2.0), F.least(F.lit(2.0), lean)))
    top = used.where(F.abs("lean") >= 1.0).orderBy(F.desc("c"), "word").limit(MOST_CONTEXT).collect()
    return tuple((r["word"], r["lean"]) for r in sorted(top, key=lambda r: r["word"]))


def _fit(features: np.ndarray, toxic: np.ndarray, prior: float = 1.0, rounds: int = 25) -> tuple[float, ...]:
    """Logistic regression by Newton's method; a weight but the constant's is held to its start by a normal prior."""
    start = np.array(Model().weights)
    weights, hold = start.copy(), np.diag([1e-6, *[prior] * (features.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (toxic - p) - hold @ (weights - start)
        curve = (features * (p * (1 - p))[:, None]).T @ features + hold
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(weights)), slope)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weights)


def scored(df: DataFrame, model: Model, what: str = "score", text: str = "text") -> DataFrame:
    """Add ``score``, ``features`` (of the classifier) or ``spans`` (``start``, ``end``, ``edits``, ``quoted`` of the terms).

    Whole texts are read.  Null and empty texts have no terms, and the score of a text without terms.  Rows are
    independent: ties, repeats and skew do not matter.  A column of the new name is replaced, all others pass through.
    """
    kinds = {
        "score": ("double", pa.float64(), Scorer.score),
        "features": ("array<double>", pa.list_(pa.float64()), Scorer.features),
        "spans": (
            "array<struct<start:int,end:int,edits:int,quoted:boolean>>",
            pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("quoted", pa.bool_())])),
            lambda s, t: [dict(zip(("start", "end", "edits", "quoted"), h[:4], strict=True)) for h in (s.hits(t) if t else [])],
        ),
    }
    kind, arrow, function = kinds[what]
    rest = df.select(*[c for c in df.columns if c != what])
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), f"{what} {kind}"])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for block in blocks(batches, text):
            found = pa.array([function(scorer, t) for t in block.column(text).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*block.columns, found], [*block.schema.names, what])

    return rest.mapInArrow(released(run), fields)


def predictions(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether its label was held out, its score, and whether it counts as toxic."""
    model = learn(spark, documents, labels)
    asked = documents.select("doc_id", "text", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    return scored(asked, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
