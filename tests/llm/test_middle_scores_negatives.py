"""Fill-in-the-middle, language-model scores and hard negatives against plain brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from oremill.llm import fill_middle, hard_negatives, kneser_ney
from oremill.llm.common import mix64, prepare

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD_TEXTS = [
    None, "", " ", " \n\t", "one", " one", "one ", "a b", "<P>", "a <S> b", "x" * 200_000, "x" * 65_535 + "é" * 70_000, " " * 150_000,
    "é ü 　 ß x\x1c y\x85z", "<" * 30 + " P> <S <M", "word " * 50_000, "퟿\U0001f600 " * 3_000, "<P <S <M " * 500,
]


def documents(spark, texts=ODD_TEXTS, times: int = 9):
    rows = [(i if i != 5 else None, t) for i, t in enumerate(list(texts) * times)]
    rows += [(3, "the same id"), (3, "the same id"), (3, "the same id and another text"), (None, "no id at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    return df.withColumns({"row": F.lit("?"), "form": F.lit("!"), "learned": F.lit(1), "block": F.lit(2)}), rows


def middle(doc_id, text):
    text = text or ""
    units, hexes = UNIT.findall(text), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("units", "size"), [(2048, 1 << 16), (3, 40)])
def test_middle_equals_brute_force(spark, monkeypatch, units, size):
    prepare(spark)
    monkeypatch.setattr(fill_middle, "PIECE_UNITS", units)
    monkeypatch.setattr(fill_middle, "PIECE_BYTES", size)
    if size < 100:  # pieces are made in workers, which see the module's own sizes: cut here as they do
        for text in ODD_TEXTS:
            data = (text or "").encode()[:20_000]
            data = data.decode(errors="ignore").encode()
            pieces = list(fill_middle._pieces(data, 0, len(data), fill_middle.unit_ends(data)))
            assert b"".join(pieces) == data and all(0 < len(p) <= size for p in pieces)
            assert all(p.decode() is not None for p in pieces)
        return
    df, rows = documents(spark)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(i, *middle(i, t)[:4], sha(middle(i, t)[4]), sha(t or "")) for i, t in rows]
    found = [tuple(r) for r in fill_middle.digests(spark, df).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    texts = [tuple(r) for r in fill_middle.transformed(spark, df).collect()]
    assert sorted(map(repr, texts)) == sorted(repr((i, *middle(i, t))) for i, t in rows)


def test_marks_are_found_across_pieces():
    text = {0: b"prefix <", 1: b"<M middle", 2: b"> suffix <P"}
    for form, order in fill_middle.ORDER.items():
        output = b"".join(mark + text[part] for mark, part in order)
        for size in range(1, len(output) + 1):
            marks, found = fill_middle.Marks(form), defaultdict(bytes)
            for at in range(0, len(output), size):
                for part, data in marks.feed(output[at : at + size]):
                    found[part] += data
            for part, data in marks.feed(b"", last=True):
                found[part] += data
            assert dict(found) == text


def test_second_sort_takes_no_shuffle(spark):
    df, _ = documents(spark, ["a b c"], 3)
    prepare(spark)
    outputs = fill_middle.assembled(df, 3)
    again = fill_middle.restored(outputs)
    assert again.partitioner == outputs.partitioner and again.getNumPartitions() == 3
    # One deal of rows: a single stage boundary stands in the lineage.
    assert again.toDebugString().decode().count("ShuffledRDD") == 1


def test_no_documents_have_no_middle(spark):
    df, _ = documents(spark)
    assert fill_middle.digests(spark, df.limit(0)).collect() == [] and fill_middle.transformed(spark, df.limit(0)).collect() == []


def kneser_ney_by_hand(train: list[list[str]], n: int):
    """The probability of a word after others, by the definition, from dictionaries of tuples."""
    counts = {n: Counter(tuple(t[i - n + 1 : i + 1]) for t in train for i in range(n - 1, len(t)))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    seen = Counter(w for t in train for w in t[n - 1 :])
    d, contexts = {}, {}
    for k, c in counts.items():
        of = Counter(c.values())
        n1, n2, n3, n4 = (of[i] for i in (1, 2, 3, 4))
        d[k] = (0.0, 0.5, 1.0, 1.5)
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            if all(0 < x < j for j, x in enumerate(found, 1)):
                d[k] = (0.0, *found)
        contexts[k] = defaultdict(list)
        for g, x in c.items():
            contexts[k][g[:-1]].append(x)

    def p(gram: tuple[str, ...]) -> float:
        k = len(gram)
        lower = p(gram[1:]) if k > 1 else 1 / (len(seen) + 1)
        after = contexts[k].get(gram[:-1])
        if not after:
            return lower
        c = counts[k][gram]
        return (c - d[k][min(c, 3)] + sum(d[k][min(x, 3)] for x in after) * lower) / sum(after)

    return p, seen


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected_scores(rows, n, train, held):
    token = re.compile(r"[^\x20\x09-\x0D]+")
    words = [["<s>"] * (n - 1) + token.findall(lower(t)) + ["</s> "] for _, t in rows]
    p, seen = kneser_ney_by_hand([w for (i, t), w in zip(rows, words, strict=True) if train(i)], n)
    total = sum(seen.values())
    for (i, _), w in zip(rows, words, strict=True):
        base = sum(math.log10((seen[x] + 0.1) / (total + 0.1 * (len(seen) + 1))) for x in w[n - 1 :])
        score = sum(math.log10(p(tuple(w[at - n + 1 : at + 1]))) for at in range(n - 1, len(w)))
        yield i, held(i), len(w) - n + 1, sum(seen[x] > 0 for x in w[n - 1 :]), total, base, score


def invented(count: int = 300, seed: int = 4):
    r = random.Random(seed)
    pool = [f"w{n}" for n in range(60)]
    texts = []
    for _ in range(count):
        at, text = r.randrange(60), []
        for _ in range(r.randint(0, 40)):
            at = (at * 7 + r.choice((1, 1, 1, 2, 3, r.randrange(60)))) % 60
            text.append(pool[at] if r.random() > 0.03 else f"rare{r.randrange(10**6)}")
        texts.append("  ".join(text).title() if r.random() < 0.2 else " ".join(text))
    return texts


@pytest.mark.parametrize(("order", "block", "shard"), [(2, 1 << 20, 1 << 20), (2, 900, 700), (3, 2000, 3000), (1, 900, 700), (4, 1 << 20, 3000)])
def test_scores_equal_brute_force(spark, order, block, shard):
    prepare(spark)
    df, rows = documents(spark, [*invented(), None, "", " \t", "ÀÉ àé AÀ", "w1 w2 w1\x1cw2", "the end of text  w1"], 1)
    part = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    found, model = kneser_ney.learn_and_score(spark, df, remainder != 0, remainder == 0, order, block, shard)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = sorted(expected_scores(rows, order, lambda i: part(i) not in (0, None), lambda i: part(i) == 0), key=repr)
    assert len(got) == len(want) and sum(r[1] for r in got) > 20
    by = lambda rows: sorted((*map(repr, r[:5]), round(r[5], 6), round(r[6], 6)) for r in rows)
    assert by(got) == by(want)
    assert model.tokens == want[0][4] and model.tables.select("level").distinct().count() == order
    # The stored model scores the same documents the same, and its arrays are sorted.
    again = kneser_ney.score(spark, df, model, 1500).collect()
    assert sorted((repr(r.doc_id), round(r.score, 6)) for r in again) == sorted((repr(r[0]), round(r[6], 6)) for r in want)
    for row in model.tables.collect():
        gaps, values = kneser_ney.unpack(row.data)
        assert (gaps[1:] > 0).all() and values.shape == (kneser_ney._columns(row.level, order), len(gaps))
    if order == 2:
        held = [r for r in got if r[1]]
        assert sum(r[6] for r in held) > sum(r[5] for r in held) + 50


def test_probabilities_of_a_context_add_up_to_one():
    train = [["<s>", *t.split(), "</s> "] for t in invented(80)]
    p, seen = kneser_ney_by_hand(train, 2)
    for context in ("<s>", "w1", "w2", "never"):
        assert sum(p((context, w)) for w in [*seen, "unknown"]) == pytest.approx(1)


def test_scores_without_training_or_rows(spark):
    prepare(spark)
    df, rows = documents(spark, ["a b a", None], 1)
    never = F.lit(False)
    found, model = kneser_ney.learn_and_score(spark, df, never, F.lit(None).cast("boolean"))
    got = found.collect()
    assert len(got) == len(rows) and all((r.score, r.base_score, r.n_known, r.train_tokens, r.held_out) == (0, 0, 0, 0, False) for r in got)
    assert (model.tokens, model.words) == (0, 0)
    assert kneser_ney.scored(spark, df.limit(0)).collect() == []


def test_packed_arrays_come_back():
    r = np.random.default_rng(1)
    arrays = [np.sort(r.integers(0, 2**63, 1000).astype(np.uint64)), np.empty(0, np.int64), r.integers(0, 9, (6, 7)), np.arange(5, dtype=np.uint32)]
    for a, b in zip(arrays, kneser_ney.unpack(kneser_ney.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.shape == b.shape and (a == b).all()


def negatives_by_hand(rows, is_anchor):
    """Rows are (id, label, vector), all usable; ids order nulls last."""
    ints = [[math.floor(256 * x) for x in v] for _, _, v in rows]
    out = []
    for a, (i, label, _) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(ints[a], ints[b], strict=True)), j is None, j or 0, lb) for b, (j, lb, _) in enumerate(rows) if b != a and len(ints[b]) == len(ints[a])]
        scored.sort()
        for p, _, pid, _ in [s for s in scored if s[3] == label][:5]:
            hits = [s for s in scored if s[3] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(i, pid, k, s[2], -p, -s[0]) for k, s in enumerate(hits, 1)]
    return out


@pytest.mark.parametrize(("blocks", "anchors"), [(4096, 512), (16, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, blocks, anchors):
    prepare(spark)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "CELL_BLOCKS", 2)
    r = np.random.default_rng(3)
    base = r.normal(size=(12, 5))
    rows = [(n, int(r.integers(0, 3)), (base[r.integers(0, 12)] * r.choice((0.2, 1, 1)) + r.normal(size=5) * r.choice((0, 0.05, 0.3))).tolist()) for n in range(260)]
    rows += [(1000 + n, n % 3, rows[0][2]) for n in range(40)]  # ties
    rows += [(2000 + n, 1, [0.0] * 5) for n in range(8)] + [(2100, 1, [1.0, 2.0]), (2200, 2, [1.0, 1.0]), (2300, 2, []), (2400, 1, [])]
    rows += [(2500 + n, n % 2, [1e6 * (n + 1), 0.0, 1.0, 0.0, -3.0]) for n in range(6)]  # beyond exact products of doubles
    odd = [(3000, None, [1.0] * 5), (3010, 1, None), (3020, 1, [None] + [1.0] * 4), (3030, 1, [float("nan")] * 5), (3040, 1, [float("inf")] * 5)]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, vector array<double>").repartition(4)
    df = df.withColumns({"row": F.lit("?"), "score": F.lit(1), "positives": F.lit(2)})
    found = [tuple(x) for x in hard_negatives.mine(spark, df, F.col("vec_id") % 20 == 0).collect()]
    expected = negatives_by_hand(rows, lambda i: i % 20 == 0)
    assert len(expected) > 200 and sorted(found) == sorted(expected)


def test_negatives_of_repeated_and_null_ids(spark):
    prepare(spark)
    rows = [(20, 0, [1.0, 0.0])] * 2 + [(None, 0, [1.0, 0.1]), (None, 1, [0.5, 0.0]), (1, 1, [0.5, 0.0]), (1, 1, [0.5, 0.0]), (2, 1, [0.2, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    found = sorted((tuple(x) for x in hard_negatives.mine(spark, df, F.col("vec_id") % 20 == 0, negatives=2).collect()), key=repr)
    # Each of the two anchors has the other one and the row without an id as positives.
    one = [(20, p, k, 1, 65536, 32768) for p in (20, None) for k in (1, 2)]
    assert found == sorted(one * 2, key=repr)
    assert hard_negatives.mine(spark, df.limit(0), F.lit(True)).collect() == []
    assert hard_negatives.mine(spark, df, F.lit(False)).collect() == []
    with pytest.raises(ValueError, match="hundredths"):
        hard_negatives.mine(spark, df, F.lit(True), low=50, high=40)


def test_scores_are_held_in_64_bits():
    def block(rows):
        data = np.array(rows, float)
        n = len(data)
        return hard_negatives.Block(data.shape[1], np.arange(n).tobytes(), np.arange(n).tobytes(), bytes(n), np.zeros(n, np.int64).tobytes(), data.tobytes())

    found = hard_negatives.scores(block([[1e300, 2.0], [3.0, 4.0]]), block([[1e300, 0.0], [-1e300, 1.0], [2.0**53, 1.0], [5.0, 6.0]]))
    top = (1 << 63) - 1
    assert found.tolist() == [[top, -top - 1, top, top], [top, -top - 1, 3 * 2**53 + 4, 39]]


def test_facts_of_many_n_grams_take_little_memory():
    """A few words in very many pairs: what is told about the words must not take many times the room of the pairs."""
    r = np.random.default_rng(5)
    words, counts = mix64(r.integers(0, 5_000, (400_000, 2)).astype(np.uint64)), r.integers(1, 5, 400_000)
    tracemalloc.start()
    try:
        shorter, told = kneser_ney._facts(words, counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 5 * words.nbytes
    expected = defaultdict(lambda: [0] * 5)
    for (a, b), n in zip(words.tolist(), counts.tolist(), strict=True):
        expected[b][0] += 1
        expected[a][1] += n
        expected[a][1 + min(n, 3)] += 1
    assert {w: t for [w], t in zip(shorter.tolist(), told.tolist(), strict=True)} == expected


def test_workers_give_freed_memory_back():
    """Small objects fill the allocator's heap, and one that stays on top keeps it from shrinking by itself."""
    code = """
import re
import pyarrow as pa
from oremill.llm.common import released
held = lambda: sum(int(n) for n in re.findall(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())) // 1024
def run(batches):
    some = [bytearray(1000) for _ in range(100_000)]
    kept.append(bytearray(1000))
    yield from batches
    del some
kept, before = [], held()
assert len(list(released(run)(iter([pa.RecordBatch.from_pydict({"x": [1]})])))) == 1
assert held() - before < 30, held() - before
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2])
