"""op11, op12 and op13 against brute force, with edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import EDGES, PHRASE

from salescast.llm import annsearch, lexical, whitening

VECTORS = "vec_id long, embedding array<double>, i string, x string, w string, leaf string, at string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d", "e") for i, v in rows], VECTORS)


BAD = [(9001, None), (9002, [1.0, None] + [0.0] * 6), (9003, [float("nan")] * 8), (9004, [float("inf")] + [1.0] * 7), (9005, [])]


def test_whitening_is_brute_force(spark):
    rng = np.random.default_rng(11)
    mix = rng.normal(size=(8, 8))
    rows = [(i, [float(c) for c in rng.normal(size=8) @ mix]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(300)] + [(5, rows[5][1]), (None, rows[6][1]), (8000, [-0.0] * 8)]
    got = whitening.whitening_query(vectors(spark, rows + BAD + [(9100, [1.0, 2.0])])).collect()
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64) + 0
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 4 * len(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for (i, v), own in zip(rows, x, strict=True):
        for c in range(4):
            r = by[i, c + 1][0]
            want = float((own - sums / n) @ axes[:, c] / math.sqrt(values[c]))
            sign = signs.setdefault(c, 1 if abs(want - r.whitened) < abs(want + r.whitened) else -1)
            assert abs(want - sign * r.whitened) < 1e-9 and r.n == n and r.deviation == int(((n * own - sums) ** 2).sum())
            assert abs(r.explained - values[c] / values.sum()) < 1e-9 and r.identity_error < 1e-9
    assert {len(v) for k, v in by.items() if k[0] == 5} == {2}


def test_whitening_of_odd_tables(spark):
    assert whitening.whitening_query(vectors(spark, [])).count() == 0
    assert whitening.whitening_query(vectors(spark, BAD)).count() == 0
    assert whitening.whitening_query(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing varies
    one = whitening.whitening_query(vectors(spark, [(1, [0.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in one) == [(1, 1, 2, 65536), (2, 1, 2, 65536), (2, 1, 2, 65536)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == 1.0 for r in one)


def nearest(rows, queries, k=20):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows])
    out = {}
    for q in queries:
        s = (m * dict(rows)[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def answers(got):
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return by


def test_ann_reaches_its_recall(spark, monkeypatch):
    for name, value in (("LEAF_ROWS", 32), ("BIN_ROWS", 500), ("BLOCK_QUERIES", 40), ("FIT_ROWS", 1500), ("CALIBRATION", 60)):
        monkeypatch.setattr(annsearch, name, value)  # many bins and blocks
    rng = np.random.default_rng(13)
    mid = rng.normal(size=(40, 8)) * 3
    rows = [(i, [float(c) for c in mid[i % 40] + rng.normal(size=8) * 0.4]) for i in range(4000)]
    rows += [(4000 + i, [2.0] * 8) for i in range(1500)]  # one leaf over three bins
    note = {}
    got = answers(annsearch.ann_query(vectors(spark, rows + BAD + [(9100, [0.0] * 8), (None, [1.0] * 8), rows[0]]), note).collect())
    want = nearest(rows, [i for i, _ in rows if i % 20 == 0])
    assert sorted(got) == sorted(want) and note["visits"] < note["leaves"]
    hits = 0
    exact = dict(rows)
    for q, top in got.items():
        assert [r for r, _, _ in top] == list(range(1, 21)) and len({v for _, v, _ in top}) == 20
        assert all(abs(s - float(np.dot(exact[q], exact[v]))) < 1e-9 for _, v, s in top)
        assert top == [(k + 1, v, s) for k, (s, v) in enumerate(sorted(((s, v) for _, v, s in top), key=lambda x: (-x[0], x[1])))]
        hits += len({v for _, v, _ in top} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    ties = [v for _, v, _ in got[4000]][:3]
    assert ties == [v for v, _ in want[4000]][:3]  # the smaller ids


def test_ann_of_small_tables_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(15)] + [(20, [1e200, 0.0, 0.0, 0.0]), (40, [1e-200, 0.0, 0.0, 1.0])]
    got = answers(annsearch.ann_query(vectors(spark, rows + [(20, [2e200, 0.0, 0.0, 0.0]), (60, [1.0]), (61, [3.0])])).collect())
    assert [v for _, v, _ in got[60]] == [61] and set(got) == {0, 20, 40, 60}
    assert {v for _, v, _ in got[0]} == {*range(1, 15), 20, 40}  # all of them
    assert [v for _, v, _ in got[0] if v < 15] == [v for v, _ in nearest(rows[:15], [0])[0]]
    assert annsearch.ann_query(vectors(spark, [])).count() == 0
    assert annsearch.ann_query(vectors(spark, [(20, [1.0, 2.0])])).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def ranked(rows, items, k=20):
    docs = [(i, Counter(WORD.findall((t or "").translate(LOW)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in {x: None for x in items}:
        scores = []
        for i, c, n in docs:
            m = 75 + (25 * n * total) // length
            s = sum(r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in Counter(WORD.findall((text or "").translate(LOW))).items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item or 0, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def lexical_rows(n=900):
    rng = random.Random(12)
    common, rare = [f"c{i}" for i in range(30)], [f"Rare{i}É" for i in range(300)]
    rows = [(i * 3, " ".join(rng.choices(common, k=rng.choice((3, 20, 60))) + rng.choices(rare, k=2)) + "." * rng.randrange(3)) for i in range(n)]
    items = [(i, " ".join(rng.choices(common, k=4) + rng.choices(rare, k=3) + ["absent"])) for i in range(12)]
    return rows, items + [(50, "c1 c1 c2"), (51, ""), (52, None), (53, "!!"), (54, "nowhere"), (55, PHRASE), (None, "c3"), (50, "c1 c1 c2"), (50, "Rare7É")]


@pytest.mark.parametrize(("short", "width"), [(0, 64), (20, 100), (10**6, 4096)])
def test_hybrid_search_is_brute_force(monkeypatch, short, width):
    monkeypatch.setattr(lexical, "RANGE_DOCS", width)
    rows, items = lexical_rows()
    counted = [(i, Counter(lexical.terms(t))) for i, t in EDGES + rows]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, x in items for t in lexical.terms(x)}))}
    shard = lexical.Shard(lexical.pack([(i, sum(c.values()), [(vocabulary[t], n) for t, n in c.items() if t in vocabulary]) for i, c in counted if c]))
    df = Counter(t for _, c in counted for t in c)
    total, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    search = lexical.Search(shard, {n: lexical.weight(total, df[t]) for t, n in vocabulary.items()}, total, length, short)
    got = []
    for item, text in dict.fromkeys(items):
        docs, scores = search.top(lexical.Item(0, {vocabulary[t]: n for t, n in Counter(lexical.terms(text)).items()}), 20)
        got += [(item or 0, r + 1, int(shard.docs[d]), int(s)) for r, (d, s) in enumerate(zip(docs, scores, strict=True))]
    assert sorted(got) == ranked(EDGES + rows, items)


def test_lexical_query(make_docs, spark, monkeypatch):
    rows, items = lexical_rows(300)
    table = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = make_docs(EDGES + rows).repartition(5)
    want = ranked(EDGES + rows, items)
    assert sorted((r.item_id or 0, r.rank, r.doc_id or 0, r.score) for r in lexical.rank_documents(docs, table).collect()) == want
    monkeypatch.setattr(lexical, "GROUP_TERMS", 30)
    assert len(list(lexical.groups(table, 30))) > 1
    assert lexical.rank_documents(docs, table.limit(0)).count() == 0 and lexical.rank_documents(make_docs([]), table).count() == 0


def test_lexical_item_groups_give_the_same(make_docs, spark, monkeypatch):
    rows, items = lexical_rows(60)
    every = lexical.groups
    monkeypatch.setattr(lexical, "groups", lambda t: every(t, 25))
    got = lexical.rank_documents(make_docs(rows), spark.createDataFrame(items[:6], "item_id long, text string")).collect()
    assert sorted((r.item_id, r.rank, r.doc_id, r.score) for r in got) == ranked(rows, items[:6])
