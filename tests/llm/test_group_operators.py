"""op4, op6, op8, op9, op10 and the pipeline: brute force and planted cases."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from conftest_llm import EDGES, PHRASE, sha

import corpus_pipeline
from salescast.llm import decontam, jaccard, quotes, topk, toxicity


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_texts(seed=1, groups=12, copies=14):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 1000
    shared = " ".join(rng.choices(vocab, k=60))
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.choice((6, 12, 30, 90, 300)))
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 8))):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((i, " ".join(words) + (" " + shared if rng.random() < 0.3 else "")))
            i += 7
    return rows


def components(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            up[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return [(i, len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("params", [jaccard.Params(), jaccard.Params(words=5, percent=80)])
@pytest.mark.parametrize("block", [1000, 8])
def test_jaccard_is_brute_force(make_docs, monkeypatch, params, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = EDGES + near_texts()
    got = [tuple(r) for r in jaccard.jaccard_groups(make_docs(rows), params).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(got, key=key) == sorted(components(rows, params.words, params.percent), key=key)


@pytest.mark.parametrize("hot", [20, 2])
def test_jaccard_hot_keys_across_tasks(make_docs, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT_KEY", hot)
    fixed = " ".join(f"fixed{i}" for i in range(12))
    many = [(i, f"id{i} {fixed}") for i in range(60)] + [(100 + i, f"id{100 + i} {fixed} extra{i}") for i in range(12)]
    few = [(200 + i, f"id{100 + i} {fixed}") for i in range(12)]
    docs = make_docs(many).coalesce(1).union(make_docs(few).coalesce(2))
    got = [tuple(r) for r in jaccard.jaccard_groups(docs).collect()]
    assert sorted(got) == sorted(components(many + few, 4, 85))


def test_jaccard_of_many_classes_on_one_key(make_docs, monkeypatch):
    """One key that 5,000 classes of many slices bring: links stay whole, and no tree is built over it."""
    monkeypatch.setattr(jaccard, "HOT_KEY", 8)
    monkeypatch.setattr(jaccard, "HOT_MEETING", 40)
    fixed = " ".join(f"fixed{i}" for i in range(12))
    rows = [(i, f"id{i // 2} {fixed}" + (" more" if i % 2 else "")) for i in range(1200)]
    got = [tuple(r) for r in jaccard.jaccard_groups(make_docs(rows).repartition(24)).collect()]
    assert sorted(got) == sorted(components(rows, 4, 85))


def test_jaccard_of_rows_without_id(make_docs):
    """Rows that share an id, or have none, don't multiply; rows that repeat in full are one text."""
    rows = [(None, f"word{i % 700} " + " ".join(f"w{(i % 700) * 3 + k}" for k in range(12))) for i in range(2000)] + [(7, f"x{i} y{i} z{i} u{i} v{i} " * 3) for i in range(50)]
    got = [tuple(r) for r in jaccard.jaccard_groups(make_docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(components(rows, 4, 85), key=str)


def test_keep_first_beside_its_own_names(make_docs):
    docs = make_docs(near_texts(groups=3)).selectExpr("*", "1 as __stays", "2 as __d2", "3 as __hash", "4 as n", "5 as root")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_components_of_a_hub(spark):
    from salescast.llm.common import connected

    edges = spark.range(1, 5001).selectExpr("0L as u", "id as v").union(spark.range(6000, 6050).selectExpr("id as u", "id + 1 as v"))
    got = {r["node"]: r["root"] for r in connected(edges, "hub").collect()}
    assert got == {**{i: 0 for i in range(1, 5001)}, **{i: 6000 for i in range(6001, 6051)}}


def test_jaccard_keys_are_shared():
    rng = np.random.default_rng(5)
    params = jaccard.Params()
    for n in (*range(1, 40), 77, 200, 1500):
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            most = int(len(a) * 0.15)
            b = np.unique(np.concatenate((a[rng.permutation(len(a))[: len(a) - rng.integers(0, most + 1)]], rng.integers(0, 2**63, rng.integers(0, most + 1), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if both < len(a) + len(b) - both and params.linked(both, len(a), len(b)):
                assert len(np.intersect1d(params.keys(a), params.keys(b)))


def test_keep_first(make_docs):
    rows = EDGES + near_texts(groups=4)
    docs = make_docs(rows)
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    by = components(rows, 4, 85)
    want = [i for i, n, c in by if n == 0] + sorted({c for _, n, c in by if n}, key=lambda x: (x is None, x or 0))
    key = lambda x: (x is None, x or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert jaccard.keep_first(make_docs([])).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))


def contamination(rows, bench):
    wins = {}
    for item, t in bench:
        w = low(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, items = low(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (g := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    items |= g
        out.append((i or 0, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_decontamination_is_brute_force(make_docs, spark):
    bench = [(10, PHRASE), (9, PHRASE), (11, "short item"), (12, None), (13, ""), (14, "Über alles 42 " * 6), (15, "one")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = EDGES + [(60, "x " * 500 + PHRASE), (61, "a short, ITEM; b"), (62, PHRASE.replace("eta ", "eta. ") + " " + PHRASE), (63, "über ALLES 42 " * 7)]
    got = sorted((r[0] or 0, *r[1:6]) for r in decontam.decontam_query(make_docs(rows), items).collect())
    assert got == contamination(rows, bench)
    assert all(r["n_hit"] == 0 for r in decontam.decontam_query(make_docs(rows), items.limit(0)).collect())
    assert decontam.decontam_query(make_docs([]), items).count() == 0


def test_decontamination_by_items_without_id(make_docs, spark):
    items = spark.createDataFrame([(None, PHRASE), (7, "short item")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.decontaminate(make_docs([(1, "x y " + PHRASE), (2, "a short item"), (3, "clean")]), items).collect()}
    assert [(got[i]["n_hit"], got[i]["items"], got[i]["contaminated"]) for i in (1, 2, 3)] == [(20, [], True), (2, ["7"], True), (0, [], False)]


def test_proximity_is_within_length_and_slop(make_docs, spark):
    wins = decontam.windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    docs = make_docs([(1, "red x x green x x blue"), (2, "red x green x blue"), (3, "red x x green blue"), (4, "blue blue x red x green green")])
    rows, runs = decontam.build_index(docs, wins, slop=2)
    hit = decontam.proximity_matches(wins, runs, 2).select("rid").distinct().join(rows, "rid")
    assert sorted(r["doc_id"] for r in hit.collect()) == [2, 3, 4]


def test_proximity(make_docs, spark):
    wins = decontam.windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    _, runs = decontam.build_index(make_docs([(1, "blue x red y green z"), (2, "red a b c d e green blue")]), wins, slop=3)
    assert {r["item"] for r in decontam.proximity_matches(wins, runs, 3).collect()} == {"1"}


def test_near_items_are_brute_force(make_docs, spark):
    """Other words may stand between a window's terms, and a repeated term need stand but once."""
    bench = [(1, PHRASE), (2, "red green blue red"), (3, "solo"), (None, "null item here")]
    w = PHRASE.split()
    rows = [(1, " ".join(w[:6] + ["zzz"] + w[6:12] + ["yyy", w[12]])), (2, " ".join(w[:6] + ["zzz", "yyy", "xxx"] + w[6:13])), (3, " ".join(reversed(w[3:16]))),
            (4, "q blue q q green q red q"), (5, "red q q q q q green blue"), (6, "green blue red"), (7, "Solo"), (8, "null item here"), (9, None), (9, " ".join(["q"] * 300 + w[:13]))]
    rows += [(k, " ".join(random.Random(k).choices(["red", "green", "blue", "q", "r", w[0], "solo"] if k % 2 else [*w[:14], "q"], k=30))) for k in range(20, 60)]
    def near(text):
        d = low(text)
        return sorted({str(i) for i, t in bench if i for x in [low(t)] for k in range(max(1, len(x) - 12)) for g in [x[k : k + 13]] for s in range(len(d)) if set(g) <= set(d[s : s + len(g) + decontam.NEAR])})
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.decontam_query(make_docs(rows), items).select("doc_id", "near_items").collect()
    assert sorted(map(tuple, got)) == sorted((i, ",".join(near(t))) for i, t in rows)


def test_topk_is_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [1.0] * 8), (20, rows[20][1]), (520, [0.0] * 8), (540, [1.0])]
    got = [tuple(r) for r in topk.topk_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    codes = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i is not None and i not in (500, 501, 502, 503)}
    want = []
    for q in (i for i in codes if i % 20 == 0):
        best = sorted((-int(np.dot(codes[q], v)), i) for i, v in codes.items() if i != q and len(v) == len(codes[q]))[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_topk_of_odd_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk.topk_query(frame([])).count() == 0
    big = [(i, [float(2**22 + i * 3), float(-(2**21) - i)]) for i in range(200)]  # scores beyond 2^53
    want = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(big[20][1], v, strict=True)), i) for i, v in big if i != 20)[:20]
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in topk.topk_query(frame(big)).collect() if r["query_id"] == 20)
    assert got == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    with pytest.raises(Exception, match="64 bits"):
        topk.topk_query(frame([(i, [1e15]) for i in range(3)])).collect()


@pytest.mark.parametrize("depths", [(0.125, 0.5, 1.0), (0.01, 0.9), (1.0,)])
def test_topk_over_many_cells(spark, monkeypatch, depths):
    for name, value in (("CANDIDATES_A_BLOCK", 400), ("QUERIES_A_BLOCK", 30), ("DEPTHS", depths)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(8)
    codes = rng.integers(-90, 90, (3000, 6))
    codes[1000:1300] = codes[7]
    rows = [(i, [float(c) / 64 for c in v]) for i, v in enumerate(codes)]
    got = sorted(tuple(r) for r in topk.topk_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    want = []
    for q in range(0, 3000, 20):
        scores = codes @ codes[q]
        order = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:20]
        want += [(q, k + 1, int(i), int(scores[i])) for k, i in enumerate(order)]
    assert got == sorted(want)


def test_toxicity_learns_and_holds_out(make_docs, spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    bad = {i for i in range(1500) if rng.random() < 0.15}
    rows = [(i, " ".join(rng.choices(vocab, k=60)) + (" nasty" + rng.choice("abc") if i in bad else "")) for i in range(1500)]
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i in range(0, 1500, 2)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [(5000, None), (5001, ""), (None, "nastya")])
    got = toxicity.toxicity_query(docs, labels).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 for r in got)
    assert sum((r["predicted"] == 1) != (r["doc_id"] in bad) for r in got if r["doc_id"] is not None and r["held_out"]) <= 4
    assert {r["predicted"] for r in toxicity.toxicity_query(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity_query(make_docs([]), labels).count() == 0


def test_nnpu_fit_lowers_the_corrected_risk():
    """The fitted weights against the risk written out plainly: below that of no weights, and no direction is much better."""
    rng = np.random.default_rng(4)
    toxic = rng.random(1200) < 0.2
    x = np.column_stack([rng.random(1200) < np.where(toxic, 0.9, 0.05), rng.random(1200) < 0.3, rng.random(1200) < np.where(toxic, 0.6, 0.2)]).astype(np.float64)
    positive, unlabelled = toxic & (rng.random(1200) < 0.5), np.ones(1200, bool)
    sample = toxicity.Sample(steps=600, rate=0.05)
    prior = float(toxic.mean())

    def risk(w, b):
        z = x @ w + b
        loss = lambda s: np.logaddexp(0, -s)
        return prior * loss(z[positive]).mean() + max(0.0, loss(-z[unlabelled]).mean() - prior * loss(-z[positive]).mean()) + sample.decay / 2 * (w @ w)

    w, b = toxicity.nnpu_fit(x, positive, unlabelled, prior, sample)
    fitted = min(risk(w, b + d) for d in np.linspace(-2, 2, 81))  # the bias is then set by the prior
    assert fitted < risk(np.zeros(3), np.log(prior / (1 - prior))) - 0.05
    for k in range(3):
        for step in (-0.3, 0.3):
            assert min(risk(w + step * np.eye(3)[k], b + d) for d in np.linspace(-2, 2, 81)) > fitted - 0.01
    scores = 1 / (1 + np.exp(-(x @ w + b)))
    assert scores[toxic].mean() > 0.6 and scores[~toxic].mean() < 0.15


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nThanks"), (1, 1, "assistant", "> how do I sort a LIST\n\nUse sorted."), (1, 2, "user", "Another topic"),
        (1, 3, "user", "> > How do I sort a list?\n> Use sorted.\n\nGreat"), (2, 0, "user", "> Another topic\nhello"), (2, 1, None, None), (None, 0, "user", "> Thanks"), (1, 2, "user", "Another topic"), (2, 2, "user", "> nowhere said"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1, 1]["parent_turn"] == 0 and got[1, 1]["body"] == "Use sorted."
    assert (got[1, 3]["parent_turn"], got[1, 3]["root_turn"], got[1, 3]["depth"], got[1, 3]["n_linked"]) == (1, 0, 2, 2)
    assert (got[2, 0]["parent_conv"], got[2, 0]["parent_turn"]) == (1, 2) and got[2, 1]["body"] == "" and got[2, 2]["parent_turn"] is None
    assert quotes.link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_quotes_of_parts(spark):
    rows = [
        (1, 0, "user", "line one\nline two\nline three\n\nsecond\nparagraph\n\nthird paragraph"),
        (1, 1, "assistant", "> line one\n> line two\nreply between\n> line three"),  # lines of a paragraph
        (1, 2, "user", "> second paragraph\n>\n> Third\n> paragraph\nwrapped anew"),  # two of three paragraphs
        (1, 3, "user", "> line three\n> second\nlines across paragraphs"), (1, 4, "user", "> line one\n> line three\nnot a run"),
        (5, 0, "user", "> said elsewhere\nasks before its own conversation says it"), (5, 1, "user", "said elsewhere"), (9, 4, "user", "said elsewhere"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == len(rows)
    assert [(got[1, t]["parent_turn"], got[1, t]["n_quotes"], got[1, t]["n_linked"]) for t in (1, 2, 3, 4)] == [(0, 2, 2), (0, 1, 1), (0, 1, 1), (None, 1, 0)]
    assert (got[5, 0]["parent_conv"], got[5, 0]["parent_turn"]) == (9, 4)


def test_reply_order_is_a_walk_of_the_tree(spark, monkeypatch):
    """Against a plain recursive walk over random reply trees, a long chain and a turn of very many replies."""
    monkeypatch.setattr(quotes, "RUN_TURNS", 4)
    rng = random.Random(9)
    rows = []
    for conv, n in ((1, 40), (2, 1), (3, 25)):
        rows += [(conv, 2 * t, conv if t and rng.random() < 0.7 else None, 2 * rng.randrange(t) if t else None) for t in range(n)]
    rows = [(c, t, p, q if p else None) for c, t, p, q in rows]
    rows += [(4, t, 4 if t else None, t - 1 if t else None) for t in range(60)] + [(5, t, 5 if t else None, 0 if t else None) for t in range(60)]
    rows += [(6, 0, None, None), (6, 1, 1, 4), (6, 1, 1, 4), (None, 0, None, None), (6, None, None, None)]  # a link to another conversation, a repeated turn
    table = spark.createDataFrame(rows, "conv_id long, turn long, parent_conv long, parent_turn long")
    got = {}
    for r in quotes.reply_order(table).collect():
        got.setdefault(r["conv_id"], []).append((r["place"], r["turn"]))
    for conv in (1, 2, 3, 4, 5, 6):
        own = {(t, q if p == conv else None) for c, t, p, q in rows if c == conv and t is not None}

        def walk(turn):
            return [turn, *(x for t, q in sorted(own, key=lambda y: y[0]) if q == turn for x in walk(t))]

        order = [x for t, q in sorted(own, key=lambda y: y[0]) if q is None for x in walk(t)]
        assert sorted(got[conv]) == list(enumerate(order, 1))
    assert set(got) == {1, 2, 3, 4, 5, 6}


def test_conversations_keep_every_message(spark):
    rows = [(1, 0, "user", "first words here"), (1, 1, "assistant", "> first words here\nanswer one"), (1, 2, "user", "another thing said"), (1, 3, "assistant", "> answer one\nmore on one"), (1, 3, "assistant", "> answer one\nmore on one"), (None, 1, "user", "x"), (2, 0, None, None)]
    got = sorted(((r["conv_id"] or 0, r["turn"], r["place"]) for r in quotes.quotes_query(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    assert got == sorted([(1, 0, 1), (1, 1, 2), (1, 3, 3), (1, 3, 3), (1, 2, 4), (0, 1, None), (2, 0, 1)], key=str)


def test_near_items_of_a_query(make_docs, spark):
    items = spark.createDataFrame([(1, PHRASE), (2, "short little item"), (None, "no id")], "item_id long, text string")
    swapped = PHRASE.split()
    swapped[3], swapped[9] = swapped[9], swapped[3]
    docs = make_docs([(1, "x " + PHRASE), (2, " ".join(swapped)), (3, "item little short"), (4, "clean words"), (5, "short item"), (6, None), (7, "no id")])
    got = {r["doc_id"]: (r["n_items"], r["n_near"], r["near_items"]) for r in decontam.decontam_query(docs, items).collect()}
    assert got == {1: (1, 1, "1"), 2: (0, 1, "1"), 3: (0, 1, "2"), 4: (0, 0, ""), 5: (0, 0, ""), 6: (0, 0, ""), 7: (0, 0, "")}


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, clashing columns and an empty table go through all stages."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, ids string, n_tokens int, decoded_sha256 string, contaminated boolean, rid string, __stays string"
    rows = [(i, t, "en", "s", len(t or ""), 0.5, "x", "y", 7, "z", False, "r", "k") for i, t in [(1, None), (None, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, "token = abcdef123456 here"), (None, "one two three four five six")]]
    for name, table in (("some", spark.createDataFrame(rows, kind)), ("none", spark.createDataFrame([], kind))):
        d = str(tmp_path / name)
        table.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, PHRASE)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = corpus_pipeline.run(spark, d).collect()
        if name == "none":
            assert got == []
            continue
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 3), (False, 4), (True, 0)]
        assert {(r["ids"], r["n_tokens"], r["decoded_sha256"], r["__stays"]) for r in got} == {("y", 7, "z", "k")}
        clean = {r["doc_id"]: r["decoded_sha256_"] for r in got}
        assert clean[3] == sha("one two three four five six") and clean[4] == sha("[SECRET] here") and clean[1] == clean[2] == sha("")


def test_pipeline_stages(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "tokens"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    score = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_query(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    kept = [(i, r["text"]) for i, r in sorted(rows.items()) if not score[i]]
    kept = [(i, t) for (i, t), (_, n, c) in zip(kept, components(kept, 5, 80), strict=True) if n == 0 or c == i]
    bench = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in contamination(kept, bench) if not r[-1]}
    got = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in got} == clean and len(got) == len(clean)
    assert set(docs.columns) - {"text"} <= set(got[0].asDict())
