"""Language identification and toxicity: held-out accuracy, edge cases, and the automaton against edit distances."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from oremill.llm import lang_id, toxicity
from oremill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def larger(sf_dir):
    """The smallest table has too few held-out rows to measure anything."""
    return sf_dir.replace("sf0.001", "sf0.01")


def test_languages_of_held_out_documents(spark, larger):
    documents = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language_id"](spark, larger).join(documents, "doc_id").collect()
    assert len(rows) == documents.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    train = spark.createDataFrame([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de"), (None, "fr"), ("x", None)], "text string, lang string")
    known = lang_id.learn(train)
    assert sorted(name for name, _ in known) == ["de", "en"]
    odd = [(1, None), (2, ""), (3, "123 !?"), (4, "the cat and the dog"), (4, "the cat and the dog"), (None, "der hund und die katze"), (5, "Ⅷ"), (6, "the cat and the dog " * 20_000)]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({"lang_pred": F.lit("?"), "lang": F.lit("zz")})
    out = sorted((r.doc_id or 0, r.lang_pred, r.score > 0) for r in lang_id.classify(spark, df, known).collect())
    assert out == [(0, "de", True), (1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (5, "und", False), (6, "en", True)]
    rejected = lang_id.classify(spark, df, known, min_margin=1e9).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in rejected] == ["und"]


def test_language_without_training_rows(spark):
    df = spark.createDataFrame([(1, "the dog", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang_id.predictions(spark, df).collect()] == [("und", 0.0)]
    assert lang_id.predictions(spark, df.limit(0)).count() == 0


def distance(a: str, b: str) -> int:
    """Edits with swapped neighbours, no part edited twice."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 2 : i] == b[j - 2 : j][::-1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_finds_what_edit_distances_find():
    r = random.Random(1)
    whole = {"".join(r.choice("abc") for _ in range(r.randint(2, 9))) for _ in range(25)}
    stems = {"".join(r.choice("abc") for _ in range(r.randint(4, 9))) for _ in range(4)} - whole
    automaton = toxicity.Automaton({**dict.fromkeys(whole, False), **dict.fromkeys(stems, True)})
    for _ in range(3_000):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 11)))
        if r.random() < 0.5:
            word = r.choice(sorted(whole | stems))
            for _ in range(r.randint(0, 2)):
                at = r.randint(0, len(word))
                word = word[:at] + r.choice(["", "a", "d"]) + word[at + r.randint(0, 1) :]
        found = [d for t in whole if (d := distance(word, t)) <= toxicity.edits_allowed(t, False)]
        for t in stems:
            found += [d for n in range(1, len(word) + 1) if (d := distance(word[:n], t)) <= toxicity.edits_allowed(t, True)]
        assert automaton.edits(word) == min(found, default=9), word


def test_toxicity_of_held_out_documents(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op7_toxicity"](spark, larger).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert QUERIES["op7_toxicity"](spark, larger).count() == spark.read.parquet(f"{larger}/documents.parquet").count()


def test_misspelled_abuse_scores_above_quotation():
    scorer = toxicity.Scorer(toxicity.Model((("moron", False), ("worthless", False))))
    clean, quoted, abuse = "a plain text about nothing much", 'they wrote "you moron" on the wall, it was reported', "you moron, you wortless moorn"
    assert scorer.score(clean) < scorer.score(quoted) < 0.5 < scorer.score(abuse)
    assert [(h[2], h[3]) for h in scorer.hits(quoted)] == [(0, True)]
    assert [h[2] for h in scorer.hits(abuse)] == [0, 1, 1]
    assert scorer.score(None) == scorer.score("") == scorer.score(clean)


def test_toxicity_of_odd_tables(spark):
    documents = spark.createDataFrame([(1, "a b c", 0.0), (1, "a b c", 0.0), (2, None, 0.0), (None, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 1), (None, 1)], "doc_id long, toxic int")
    out = toxicity.predictions(spark, documents, labels).collect()
    assert len(out) == 4 and all(r.predicted == 0 and 0 <= r.score <= 1 for r in out)
    assert toxicity.predictions(spark, documents.limit(0), labels.limit(0)).count() == 0
    spans = toxicity.scored(documents, toxicity.Model((("abcde", False),)), "spans")
    assert spans.columns == ["doc_id", "text", "score", "spans"] and all(r.spans == [] for r in spans.collect())
