"""Near-duplicates, repeated lines and leaked test items against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oremill.llm import components, decontam, embed_dedup, line_dedup, minhash
from oremill.llm.common import stored
from oremill.llm.oracle import ORACLE
from oremill.llm.queries import QUERIES
from tests.compare import connect, duckdb_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns, expected = duckdb_rows(connect(sf_dir), ORACLE[name])
    assert sorted(result.columns) == columns
    assert spark_rows(result) == expected


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    links = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(150)] + [(n, n + 1) for n in range(500, 560)] + [(700, n) for n in range(701, 760)]
    df = spark.createDataFrame([*links, (None, 3), (3, None), (5, 5)], "a long, b long")
    found = {x.node: x.root for x in components.components(df, "test").collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert found == {n: root for n, root in closure(nodes, links).items() if n != root}


def vectors(seed: int, n: int = 400, size: int = 6):
    r = np.random.default_rng(seed)
    rows, ids = [], iter(range(10, 10**6))
    for label in (1, 2, None):
        base = r.normal(size=(n if label == 1 else 40, size))
        base = np.concatenate([base, base[:30] + r.normal(size=(30, size)) * 0.1, np.repeat(base[:1], 9, axis=0), base[1:4] * 3.0])
        rows += [(next(ids), label, v) for v in base.astype(np.float32).tolist()]
    odd = [None, [], [0.0] * size, [float("nan")] * size, [1.0, float("inf")] + [0.0] * (size - 2), [None] + [1.0] * (size - 1), [1.0, 0.0], [2.0, 0.0]]
    rows += [(next(ids), 1, v) for v in odd]
    return rows


@pytest.mark.parametrize("part_rows", [16, 1024])
def test_embedding_links_are_exact(spark, monkeypatch, part_rows):
    monkeypatch.setattr(embed_dedup, "PART_ROWS", part_rows)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 50)
    rows = vectors(1)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    links = []
    for i, (a, la, va) in enumerate(rows):
        for b, lb, vb in rows[:i]:
            ok = la is not None and la == lb and va and vb and len(va) == len(vb)
            if ok and all(x is not None and np.isfinite(x) for x in va + vb) and any(va) and any(vb):
                x, y = np.array(va, float), np.array(vb, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links.append((a, b))
    degree, root = Counter(n for link in links for n in link), closure([r[0] for r in rows], links)
    found = embed_dedup.near_duplicates(spark, df).collect()
    assert len(found) == len(rows) and len(links) > 100
    for r in found:
        assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], root[r.vec_id], root[r.vec_id] == r.vec_id)


def test_embeddings_of_odd_tables(spark):
    df = spark.createDataFrame([(1, 5, [1.0, 2.0])] * 3 + [(None, 5, [1.0, 2.1]), (2, 5, [1.0, -2.0])], "vec_id long, label int, embedding array<double>")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark, df.selectExpr("*", "1 AS h1", "2 AS id", "3 AS kind")).collect() if r.vec_id)
    assert found == [(1, 3, 1), (1, 3, 1), (1, 3, 1), (2, 0, 2)]
    assert [(r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(spark, df).where("vec_id IS NULL").collect()] == [(3, 1, False)]
    assert embed_dedup.near_duplicates(spark, df.limit(0)).count() == 0


def shingled(text):
    words = minhash.words_of(text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def probability_jaccard(a, b):
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a | b) for i in a.keys() & b.keys())


def corpus(seed: int):
    r = random.Random(seed)
    word = lambda: "w" + str(r.randint(0, 500))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([6, 40, 120]))]
        for _ in range(r.randint(1, 9)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (" " + " ".join(copy[:30]) if r.random() < 0.3 else ""))
    texts += ["Same, words!", "same words", "one", "one", "?!", "?!", "", "  ", None, None, "long " * 30_000]
    return list(enumerate(texts))


def test_similarity_is_the_formula():
    r = random.Random(2)
    for _ in range(60):
        a, b = ([r.choice("abc") for _ in range(r.randint(1, 40))] for _ in range(2))
        x, y = shingled(" ".join(a)), shingled(" ".join(b))
        found = minhash.similarity(*(minhash._unpack(minhash._pack(minhash.shingles(w))) for w in (a, b)))
        assert found == pytest.approx(probability_jaccard(x, y))


def test_registers_estimate_the_similarity():
    r = random.Random(3)
    for share in (0.0, 0.02, 0.1):
        agree, exact = [], []
        for _ in range(25):
            a = [f"w{r.randint(0, 900)}" for _ in range(150)]
            b = [w if r.random() >= share else "x" + w for w in a] + a[:40]
            s = minhash.signatures([minhash.shingles(a), minhash.shingles(b)])
            agree.append((s[0] == s[1]).mean())
            exact.append(probability_jaccard(shingled(" ".join(a)), shingled(" ".join(b))))
        assert np.mean(agree) == pytest.approx(np.mean(exact), abs=0.03)


def test_near_copies(spark):
    rows = corpus(4)
    expected = [(a, b) for a, ta in rows for b, tb in rows[:a] if (x := shingled(ta)) and (y := shingled(tb)) and probability_jaccard(x, y) >= 0.8]
    root = closure([n for n, _ in rows], expected)
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bands string").repartition(4)
    found = minhash.near_duplicates(spark, df).collect()
    assert len(found) == len(rows) and len(expected) > 20
    for r in found:
        assert (r.class_id, r.kept) == (root[r.doc_id], root[r.doc_id] == r.doc_id), rows[r.doc_id]
    assert minhash.near_duplicates(spark, df.limit(0)).count() == 0


def test_large_group_of_copies_edited_more_and_less(spark):
    """Buckets then hold several components, and members that link with none."""
    r = random.Random(11)
    base = [f"w{r.randint(0, 900)}" for _ in range(120)]
    rows = []
    for doc_id in range(150):
        copy = list(base) + (base[:20] * (doc_id % 3) if doc_id % 5 == 0 else [])
        for _ in range(r.randint(0, 14)):
            copy[r.randrange(len(copy))] = f"x{r.randint(0, 10**6)}"
        rows.append((doc_id, " ".join(copy)))
    grams = {i: shingled(t) for i, t in rows}
    held = lambda x, y: sum(x[i] for i in x.keys() & y.keys()) >= 0.8 * sum(x.values())  # noqa: E731  a bound, and quicker
    near = ((a, b) for a in grams for b in range(a) if held(grams[a], grams[b]) and held(grams[b], grams[a]))
    root = closure(grams, [(a, b) for a, b in near if probability_jaccard(grams[a], grams[b]) >= 0.8])
    assert 30 < len(set(root.values())) < 140
    found = minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.class_id for x in found} == root


def test_filter_of_large_buckets_rules_out_no_similar_pair(spark):
    """Pairs at 0.8 and just above it: few shingles, more shingles, and a line that is repeated more and less often."""
    r = random.Random(22)
    word = lambda: f"w{r.randint(0, 10**6)}"
    pairs = []
    for n in range(1500):
        base = [word() for _ in range((12, 13, 21)[n % 3])]
        pairs.append([" ".join([*base, word()]) for _ in "xy"])
    for _ in range(100):
        line = [word() for _ in range(60)]
        pairs.append([" ".join(line * 3), " ".join([*line[:30], word(), *line[31:]] * r.randint(2, 5))])
    rows = [(2 * n + side, text) for n, pair in enumerate(pairs) for side, text in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vectors = minhash._vectors(docs, docs.select(F.col("doc_id").alias("node"), "doc_id", F.xxhash64("text").alias("at")), "text")
    letters = {"bits": "s", "odd": "o"}
    words = [F.col(c)[i].alias(f"{letters[c]}{i}") for c in vectors.columns if c in letters for i in range(16)]
    each = vectors.select(F.expr("node div 2").alias("n"), F.expr("node % 2").alias("side"), F.struct("total", "more", "repeated", *words).alias("y"))
    both = each.where("side = 0").withColumnRenamed("y", "x").join(each.where("side = 1").select("n", "y"), "n")
    likely = {x.n for x in both.where(minhash._likely(0.8)).select("n").collect()}
    near = {n for n, (a, b) in enumerate(pairs) if minhash.similarity(*(minhash.shingles(minhash.words_of(t)) for t in (a, b))) >= 0.8}
    assert len(near) == len(pairs) and near - likely == set()


def test_spreads_rule_out_no_similar_pair(spark):
    """A line that is repeated more and less often, with one word changed, and texts with other words at their ends."""
    r = random.Random(23)
    word = lambda: f"w{r.randint(0, 10**6)}"
    pairs = []
    for n in range(300):
        line = [word() for _ in range((12, 21, 60)[n % 3])]
        pairs.append([" ".join([*line, word()]) for _ in "xy"] if n % 2 else [" ".join(line * 3), " ".join([*line[:5], word(), *line[6:]] * r.randint(2, 5))])
    rows = [(2 * n + side, text) for n, pair in enumerate(pairs) for side, text in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vectors = minhash._vectors(docs, docs.select(F.col("doc_id").alias("node"), "doc_id", F.xxhash64("text").alias("at")), "text")
    each = vectors.select(F.expr("node div 2").alias("n"), F.expr("node % 2").alias("side"), F.struct("spread").alias("y"))
    both = each.where("side = 0").withColumnRenamed("y", "x").join(each.where("side = 1").select("n", "y"), "n")
    close = {x.n for x in both.where(minhash._close(0.8)).select("n").collect()}
    near = {n for n, (a, b) in enumerate(pairs) if minhash.similarity(*(minhash.shingles(minhash.words_of(t)) for t in (a, b))) >= 0.8}
    assert near and len(close) < len(pairs) and near - close == set()


def test_similarity_of_spreads_is_that_of_texts_or_more_and_leaves_few_unlike_pairs(spark):
    """Texts of the same phrases, repeated in other numbers, and lines of all lengths with words changed."""
    r = random.Random(25)
    word = lambda: f"w{r.randint(0, 10**6)}"
    phrases = [" ".join(word() for _ in range(5)) for _ in range(5)]
    texts = [" ".join(" ".join([phrase] * r.randint(2, 5)) for phrase in phrases) for _ in range(60)]
    unlike = len(texts)
    for n in range(60):
        line = [word() for _ in range((3, 12, 40, 400, 4000)[n % 5])]
        texts += [" ".join(line * 3), " ".join([*line[: n % 20], word(), *line[1 + n % 20 :]] * r.randint(1, 5))]
    found = [minhash.shingles(minhash.words_of(t)) for t in texts]
    rows = [(n, int(c.sum()), int((c - 1).sum()), n, [7], minhash.spread(s, c).tolist(), *minhash.odd_sketch(s).tolist()) for n, (s, c) in enumerate(found)]
    words = ", ".join(f"o{i} long" for i in range(16))
    y = spark.createDataFrame(rows, f"node long, total long, more long, repeated long, bands array<long>, spread array<short>, {words}").repartition(4)
    pairs = [(a, b) for a in range(unlike) for b in range(a)] + [(n, n + 1) for n in range(unlike, len(texts), 2)]
    alike = {(a, b): minhash.similarity(found[a], found[b]) for a, b in pairs}
    both = spark.createDataFrame([(a, b, s) for (a, b), s in alike.items()], "a long, b long, similar double")
    both = both.join(y.select(F.col("node").alias("a"), F.struct("*").alias("x")), "a").join(y.select(F.col("node").alias("b"), F.struct("*").alias("y")), "b")
    assert both.where(~minhash._at_best(F.col("similar"))).count() == 0
    key = F.lit(7).cast("long").alias("key")
    some = y.where(F.col("node") < unlike)
    members, leaders = some.select(key, F.col("node").alias("root"), F.struct("*").alias("y")), some.select(key, F.col("node").alias("lead_root"), F.struct("*").alias("x"))
    likely = both.where((F.col("a") < unlike) & minhash._likely(0.8) & minhash._close(0.8)).count()
    near = {(b, a) for (a, b), s in alike.items() if a < unlike and s >= 0.8}
    left = {(x.a, x.b) for x in minhash._possible(members, leaders, 0.8).distinct().collect()}
    assert near - left == set() and likely - len(near) > 4 * len(left - near), (len(near), len(left), likely)


def test_tasks_of_a_large_bucket_grow_with_its_members_alone(spark):
    """Two large sides of a bucket: the tasks are not as many as pairs of splits, and all pairs are found."""
    r = random.Random(24)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(40)]
    texts = [" ".join([*base, f"x{n}"]) for n in range(300)]
    found = [minhash.shingles(minhash.words_of(t)) for t in texts]
    bands = minhash.bands_of(minhash.signatures(found)).tolist()
    rows = [(n, int(c.sum()), 0, 0, bands[n], minhash.spread(s, c).tolist(), *minhash.odd_sketch(s).tolist()) for n, (s, c) in enumerate(found)]
    words = ", ".join(f"o{i} long" for i in range(16))
    y = spark.createDataFrame(rows, f"node long, total long, more long, repeated long, bands array<long>, spread array<short>, {words}")
    key = Counter(b for some in bands for b in some).most_common(1)[0][0]
    inside = [n for n in range(300) if key in bands[n]]
    expected = {(a, b) for a in inside for b in inside if a < b and min(set(bands[a]) & set(bands[b])) == key}
    every = y.where(F.array_contains("bands", F.lit(key).cast("long"))).select(F.lit(key).cast("long").alias("key"), F.struct("*").alias("y"))
    names = {"advisoryPartitionSizeInBytes": "8k", "coalescePartitions.enabled": "false", "skewJoin.skewedPartitionThresholdInBytes": "8k", "skewJoin.skewedPartitionFactor": "1.5"}
    settings = {**{f"spark.sql.adaptive.{k}": v for k, v in names.items()}, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    members = every.select("key", F.col("y.node").alias("root"), "y").repartition(16)
    leaders = every.select("key", F.col("y.node").alias("lead_root"), F.col("y").alias("x")).repartition(16)
    context = spark.sparkContext
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup("bucket", "bucket")
        assert {(x.a, x.b) for x in minhash._possible(members, leaders, 0.8).distinct().collect()} == expected
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("bucket") for s in tracker.getJobInfo(j).stageIds]
    assert len(inside) > 200 and 12 < max(s.numTasks for s in stages if s) <= 8 + 16


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    places = lambda: {p for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for p in Path(top).rglob("shuffle_*")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held, setting_before = places(), spark.conf.get(setting)
    counts = stored(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    until = time.time() + 20
    while places() - held and time.time() < until:
        time.sleep(0.2)
    assert not places() - held and spark.conf.get(setting) == setting_before
    assert counts.count() == 10


def test_buckets_of_several_components_lose_no_pair(spark):
    """Texts of 13 words, whose pairs are just at the bound, and texts of one repeated line."""
    r = random.Random(21)
    families = []
    for _ in range(5):
        middle = [f"w{r.randint(0, 10**6)}" for _ in range(11)]
        ends = [(f"f{n}", f"l{n}{side}") for n in range(40) for side in "ab"]
        families.append([" ".join([first, *middle, last]) for first, last in ends])
    line, lines = [f"v{n}" for n in range(50)], []
    for n in range(16):
        once = [*line[:10], f"c{n}", *line[11:20], f"e{n}", *line[21:]]
        twice = [*once[:30], f"d{n}", *once[31:]]
        lines += [" ".join(once * 3), " ".join(once * 4), " ".join(twice * 3)]
    texts, links = [], []
    for family in [*families, lines]:
        grams, start = [shingled(t) for t in family], len(texts)
        links += [(start + a, start + b) for a in range(len(family)) for b in range(a) if probability_jaccard(grams[a], grams[b]) >= 0.8 - 1e-9]
        texts += family
    root = closure(range(len(texts)), links)
    assert len(set(root.values())) == 5 * 40 + 16
    found = minhash.near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x.doc_id: x.class_id for x in found} == root


def test_near_copies_with_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words of the same id"), (None, "A b c d e f."), (7, "a b c d e f")]
    found = minhash.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.class_id, r.kept) for r in found) == [(0, 1, False), (1, 1, True), (1, 1, True), (1, 1, True), (7, 1, False)]


def item_texts(seed: int, n: int = 60):
    r = random.Random(seed)
    return [(i, " ".join(f"t{int(r.paretovariate(0.6)) % 90}" for _ in range(r.randint(3, 25)))) for i in range(n)]


def index_of(items):
    made = tuple(i for i in (decontam.item(*row) for row in items) if len(i.words) >= 5)
    df = Counter(t for i in made for t in decontam.terms_of(i.words))
    return decontam.Index(made, len(made), float(np.mean([len(i.words) - 1 for i in made])), df)


@pytest.mark.parametrize("block", [2, 32])
def test_wand_finds_all_items_above_the_threshold(monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_POSTINGS", block)
    index = index_of(item_texts(5, 200))
    r = random.Random(6)
    for _ in range(300):
        terms = r.sample(range(len(index.ids)), r.randint(1, 60))
        scores = Counter()
        for t in terms:
            for i, w in zip(index.ids[t], index.weights[t], strict=True):
                scores[i] += w
        least = r.choice([0.02, 0.05, 0.1, 0.3])
        assert dict(index.search(terms, least)) == pytest.approx({i: s for i, s in scores.items() if s >= least - 1e-12})


@pytest.mark.parametrize("shard_words", [100, 1_000_000])
def test_leaks(spark, monkeypatch, shard_words):
    monkeypatch.setattr(decontam, "SHARD_WORDS", shard_words)
    items = item_texts(7)
    r = random.Random(8)
    noise = lambda n: [f"n{r.randint(0, 3000)}" if r.random() < 0.7 else f"t{r.randint(0, 89)}" for _ in range(n)]
    rows, planted = [], {}
    for doc_id in range(80):
        words, planted[doc_id] = noise(r.randint(0, 200)), set()
        for _ in range(r.choice([0, 0, 1, 2])):
            item_id, text = r.choice(items)
            words += [*text.upper().split(), *noise(r.randint(0, 60))]
            if len(text.split()) >= 5:
                planted[doc_id].add(item_id)
        rows.append((doc_id, ", ".join(words), "x"))
    rows += [(100, None, "x"), (101, "", "x"), (None, items[0][1] + " " + items[1][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, leaks string")
    benchmark = spark.createDataFrame([*items, (900, None), (901, "")], "item_id long, text string")
    found = decontam.leaks(spark, df, benchmark).collect()
    assert len(found) == len(rows)
    index = index_of(items)
    for row in found:
        ids = {x.item_id for x in row.leaks}
        assert planted.get(row.doc_id, set()) <= ids
        # Whatever else is found has been verified: all of its words, nearly, stand in the text in runs of five.
        words = decontam.words_of(row.text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        by_id = {i.item_id: i for i in index.items}
        for i in ids:
            question, answer = decontam._overlap(by_id[i], runs)
            assert question >= 0.8 and answer >= 0.5
    assert decontam.contaminated(spark, df.drop("leaks"), benchmark.limit(0)).count() == 0
    assert decontam.contaminated(spark, df.limit(0), benchmark).count() == 0


def test_an_answer_column_is_verified(spark):
    question, answer = "what is the name of the river that runs through the old town", "it is the wide green river"
    benchmark = spark.createDataFrame([(1, question, answer)], "item_id long, text string, answer string")
    rows = [(1, f"x y {question} {answer} z"), (2, f"x y {question} no idea at all z"), (3, f"{answer}")]
    assert [r.doc_id for r in decontam.contaminated(spark, spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()] == [1]


def lines_left(rows, least):
    """Brute force: every window of lines that are not blank, in document order."""
    seen, kept = set(), {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        full = [(n, line.strip(" ")) for n, line in enumerate(lines) if line.strip(" ")]
        gone = set()
        windows = [full[i : j + 1] for i in range(len(full)) for j in range(i, len(full)) if sum(len(b) for _, b in full[i : j + 1]) >= least]
        for w in windows:
            body = tuple(b for _, b in w)
            if body in seen:
                gone |= {n for n, _ in w}
            seen.add(body)
        kept[doc_id] = ("\n".join(line for n, line in enumerate(lines) if n not in gone), len(gone))
    return kept


@pytest.mark.parametrize(("seed", "least"), [(1, 1), (2, 4), (3, 9), (4, 20), (5, 40)])
def test_repeated_lines(spark, seed, least):
    r = random.Random(seed)
    line = lambda: r.choice(["a", "bb", "ccc", " dddd", "eeeee", "", "  ", "f" * 12, "long line " + str(r.randint(0, 40))])
    block = [line() for _ in range(12)]
    rows = []
    for doc_id in range(25):
        lines = [line() for _ in range(r.randint(0, 12))]
        start = r.randint(0, 8)
        lines += block[start : start + r.randint(0, 8)] + [line() for _ in range(r.randint(0, 5))]
        rows.append((doc_id, "\n".join(lines)))
    rows.append((30, "\n".join(["again and again and again"] * 20)))
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id long, text string, at int, gone string").repartition(3)
    out = line_dedup.dedup(spark, df, min_chars=least)
    assert out.columns == ["doc_id", "text", "n_lines", "n_deleted"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian") if node in plan]
    assert {x.doc_id: (x.text, x.n_deleted) for x in out.collect()} == lines_left(rows, least)


def test_lines_of_odd_rows(spark):
    passage = "a passage that is long enough to be deleted"
    rows = [(1, None), (2, ""), (3, " \n "), (None, passage), (4, passage), (4, passage), (4, passage + "\nmore"), (5, f"x\n{passage} \n\ny")]
    out = line_dedup.dedup(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.doc_id or 0, r.text if r.text is not None else "null", r.n_lines, r.n_deleted) for r in out)
    assert found == [
        (0, passage, 1, 0), (1, "null", 0, 0), (2, "", 0, 0), (3, " \n ", 0, 0), (4, "", 1, 1), (4, "", 1, 1), (4, "more", 2, 1), (5, "x\n\ny", 3, 1),
    ]
    assert line_dedup.deduped(spark, spark.createDataFrame(rows, "doc_id long, text string").limit(0)).count() == 0


def test_line_dedup_of_a_hundred_thousand_repeated_lines(spark):
    again = "the same long line comes again and again"
    text = "\n".join(again if n % 2 else f"line number {n} is by itself" for n in range(100_000))
    df = spark.createDataFrame([(1, text), (2, again), (3, None)], "doc_id long, text string")
    line_dedup.dedup(spark, df.where("doc_id > 1")).collect()  # compiled before the clock starts
    begun = time.monotonic()
    found = {r.doc_id: r for r in line_dedup.dedup(spark, df).collect()}
    assert time.monotonic() - begun < 60
    assert (found[1].n_lines, found[1].n_deleted, found[2].n_deleted, found[2].text) == (100_000, 49_999, 1, "")
    assert found[1].text.split("\n") == [line for n, line in enumerate(text.split("\n")) if n < 2 or n % 2 == 0]


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark, tmp_path):
    r = random.Random(9)
    line = lambda n: " ".join(f"v{r.randint(0, 4000)}" for _ in range(n))
    rude = ["moron", "worthless", "scum"]
    docs, labels = [], []
    for n in range(300):
        text = "\n".join(line(40) for _ in range(4))
        if n % 6 == 0:
            words = text.split(" ")
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(rude))
            text = " ".join(words)
        docs.append((n, text))
        labels.append((n, 1, int(n % 6 == 0)))
    exam = [(i, line(25)) for i in range(5)]
    near = docs[1][1].split(" ")
    near[20] = "other"
    docs += [(400, docs[1][1]), (401, " ".join(near).replace("\n", " ")), (402, f"{line(30)}\n{exam[2][1]}\n{line(30)}"), (403, f"{docs[2][1].splitlines()[0]}\n{line(30)}"), (404, ""), (405, None)]
    full = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(exam, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "minhash near-dedup", "benchmark decontamination", "byte-level bpe"]
    out = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # Toxic ones, the copy (all of its lines), the near copy on one line, and the leak are gone.
    assert set(out) == {i for i, _ in docs if not (i < 300 and i % 6 == 0)} - {400, 401, 402}
    import hashlib

    for i, text in docs:
        if i in out and i != 403:
            assert out[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert out[403].decoded_sha256 == hashlib.sha256(dict(docs)[403].split("\n")[1].encode()).hexdigest()
    assert out[404].n_tokens == out[405].n_tokens == 0 and len(out[1].tokens) == out[1].n_tokens
