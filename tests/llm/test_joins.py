"""op1 and op4 against brute force; components; op8 held-out accuracy."""
import random

import numpy as np
import pytest


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    from riskmart.llm.common import components
    rng = random.Random(1)
    links = [(f"{a:03d}", f"{b:03d}") for a, b in ((rng.randint(0, 199), rng.randint(0, 199)) for _ in range(150))]
    links += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(70)]  # a long path
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string"), "a", "b", "t").collect()}
    used = {n for a, b in links if a != b for n in (a, b)}
    assert got == closure(used, links)
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b", "t").count() == 0


def vectors():
    rng = np.random.default_rng(2)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            centre = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 5))):
                rows.append((at, (centre + rng.normal(size=8) * 0.25).tolist(), label))
                at += 1
    hot = rng.normal(size=8)
    for i in range(120):  # a group of near copies and one of copies
        rows.append((at + i, (hot + (rng.normal(size=8) * 0.05 if i % 2 else 0)).tolist(), 1))
    at += 120
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    return rows + [(at + i, v, 0) for i, v in enumerate(odd)]


def embedding_brute(rows, t=0.93):
    good = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, float))
    links = []
    ids = sorted(good)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            (la, a), (lb, b) = good[i], good[j]
            if la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= t:
                links.append((i, j))
    n = dict.fromkeys((r[0] for r in rows), 0)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    return n, closure(n, links)


@pytest.mark.parametrize("tile_rows", [4096, 30])
def test_embedding_join_equals_brute_force(spark, tile_rows):
    from riskmart.llm.embedding_dedup import near_duplicates
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, kept string, cell int").repartition(4)
    got = near_duplicates(df, tile_rows=tile_rows, max_pivots=6).collect()
    n, root = embedding_brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], root[i], i == root[i]) for i in n}
    assert len(got) == len(rows) and all(r.cell == 5 for r in got)


def test_embedding_join_odd_tables(spark):
    from riskmart.llm.embedding_dedup import near_duplicates
    schema = "vec_id long, embedding array<float>, label int"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = near_duplicates(spark.createDataFrame([(None, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (None, None, 1)], schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("7", 2, "7", True), ("7", 2, "7", True), ("None", 0, "None", False), ("None", 2, "7", False)]


def jaccard_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    rows = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([1, 2, 3, 4, 5, 9, 30, 60, 200]))]
        for _ in range(rng.randint(1, 4)):
            new = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                new[rng.randrange(len(new))] = word()
            rows.append(" ".join(new) if rng.random() < 0.8 else "\n\t".join(w.upper() for w in new))
    hot = [word() for _ in range(300)]
    for i in range(60):  # a large group of near copies
        new = list(hot)
        new[i * 5] = word()
        rows.append(" ".join(new))
    return rows + [None, "", " \n", "É é", "é É", "　wide　", "w " * 40_000, "w " * 40_000, "nbsp\xa0x"]


def jaccard_brute(texts):
    import re
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    links = [(i, j) for i in sets for j in range(i + 1, len(texts)) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    return {i: len(s) for i, s in sets.items()}, closure(sets, links)


@pytest.mark.parametrize("block_rows,check_rows", [(16_384, 512), (7, 4)])
def test_jaccard_join_equals_brute_force(spark, block_rows, check_rows):
    from riskmart.llm.jaccard_join import jaccard_components
    texts = jaccard_rows()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, id string, n_shingles string").repartition(4)
    n, root = jaccard_brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, block_rows=block_rows, check_rows=check_rows).collect()}
    assert got == {i: (n[i], root[i]) for i in n}


def test_jaccard_join_odd_tables(spark):
    from riskmart.llm.jaccard_join import jaccard_components
    schema = "doc_id long, text string"
    assert jaccard_components(spark.createDataFrame([], schema)).count() == 0
    text = "one two three four five six seven"
    got = jaccard_components(spark.createDataFrame([(None, text), (4, text), (4, text), (None, "alone here"), (9, None)], schema)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [
        ("4", 4, "4"), ("4", 4, "4"), ("9", 0, "9"), ("None", 1, "None"), ("None", 4, "4")]


def test_bitmap_bound_never_drops_a_link():
    from riskmart.llm.jaccard_join import bands, bitmap, candidate_tile, shingles
    rng = random.Random(9)
    for _ in range(30):
        base = [str(rng.randint(0, 10**6)) for _ in range(rng.randint(7, 400))]
        sets = []
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                w[rng.randrange(len(w))] = "x"
            sets.append(shingles(" ".join(w)))
        root = candidate_tile(np.array([len(s) for s in sets]), [bitmap(s) for s in sets], np.ones(12, bool), True, 85)
        for i in range(12):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    assert root[i] == root[j]
    lows = bands(85, 1 << 20)
    for s in (1, 6, 17, 99, 1000, 65_537):
        k = np.searchsorted(lows, s, "right")
        assert np.searchsorted(lows, s * 100 // 85, "right") - k <= 1


def quality_rows(n=400):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("etaoin shrdlu".replace(" ", "")) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(15, 80))]
        bad = rng.random() < 0.2
        if bad:
            kind = rng.randrange(3)
            w = [x + "***" for x in w] if kind == 0 else [x.upper() + "!!" for x in w] if kind == 1 else [w[0]] * len(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_ranking_on_held_out_rows(spark):
    import zlib

    from riskmart.llm.quality import quality_model, score_quality
    rows, labels = quality_rows()
    odd = [(None, "null id"), (9001, None), (9002, ""), (9003, "x" * 200_000), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, "keep") for r in rows + odd], "doc_id long, text string, score string").repartition(3)
    model = quality_model(docs, spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (77777, 0, 0)], "doc_id long, quality int, toxic int"))
    got = score_quality(docs, model, keep=["doc_id"]).collect()
    want = {i: q for i, q, _ in labels}
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 40 and np.mean([r.predicted == want[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_without_labels_or_documents(spark):
    from riskmart.llm.quality import quality_model, score_quality
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality_model(docs, none)
    assert [r.score for r in score_quality(docs, model).collect()] == [0.5, 0.5]
    assert score_quality(docs.limit(0), model).count() == 0
    one_class = quality_model(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    assert score_quality(docs, one_class).where("predicted = 1").count() == 2
