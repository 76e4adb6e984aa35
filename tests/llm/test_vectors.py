"""op11, op12 and op13 against brute force, and their odd input."""
import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest

ODD = [None, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]


def table(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, label, 1, "x", "y", 0.5) for i, v, label in rows],
                               f"vec_id long, embedding array<{kind}>, label int, n int, code string, state string, score double")
    return df.repartition(5)


def vectors(n=500, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = [(centres[rng.integers(12)] + rng.normal(size=dim) * 0.3).tolist() for _ in range(n)]
    x[n // 2:n // 2 + 60] = [x[0]] * 60  # copies
    return [(int(i), v, [0, 1, None][int(i) % 3]) for i, v in zip(rng.permutation(n), x)]


# ------------------------------------------------------------------ op11
def orthonormal(rng, d):
    """A random basis in extended precision."""
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (np.eye(d) * np.longdouble(1.5) - q.T @ q / 2)
    return q


@pytest.mark.parametrize("gap", [1e-3, 1e-6, 1e-9, 1e-11])
def test_refinement_separates_clustered_values(gap):
    from riskmart.llm.whitening import refined_eigh
    rng = np.random.default_rng(5)
    q = orthonormal(rng, 20)
    values = np.longdouble(1) * np.array([5, 4, 4 + gap, 4 - gap, 3, 3 + gap / 2] + list(np.linspace(0.1, 2, 14)))
    a = (q * values) @ q.T
    got, vectors = refined_eigh((a + a.T) / 2)
    order = np.argsort(-values)
    assert np.abs(got - values[order]).max() < 1e-17 * 50
    along = np.abs((vectors * q[:, order]).sum(axis=0))
    assert np.abs(1 - along).max() < 1e-12
    away = np.abs(vectors * np.sign((vectors * q[:, order]).sum(axis=0)) - q[:, order]).max()
    assert away < max(1e-15, 1e-18 / gap * 20), away  # float64 alone leaves some 1e-16 / gap


def test_refinement_of_equal_values_and_zero():
    from riskmart.llm.whitening import refined_eigh
    rng = np.random.default_rng(6)
    q = orthonormal(rng, 9)
    values = np.array([7, 7, 7, 2, 2, 1, 0, 0, 0], np.longdouble)
    got, vectors = refined_eigh((q * values) @ q.T)
    assert np.abs(got - values).max() < 1e-17 * 50
    assert np.abs(vectors.T @ vectors - np.eye(9)).max() < 1e-16
    assert np.abs(((q * values) @ q.T) @ vectors - vectors * got).max() < 1e-16
    assert refined_eigh(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert refined_eigh(np.array([[4.0]]))[0].tolist() == [4]


def whitening_brute(rows):
    x = {i: [math.floor(256 * c) for c in v] for i, v, _ in rows}
    u = np.array(sorted(set(map(tuple, x.values()))), object)
    n, s = len(u), u.sum(axis=0)
    y = n * u - s  # exact
    cov = (y.T @ y).astype(np.longdouble) / np.longdouble(n) ** 3
    values, basis = np.linalg.eigh(cov.astype(float))
    values, basis = values[::-1], basis[:, ::-1]
    out = {}
    for i, v in x.items():
        away = np.array([n * c - t for c, t in zip(v, s)], object)
        out[i] = (int((away * away).sum()), ((away / n).astype(float) @ basis[:, :4] / np.sqrt(values[:4])))
    return n, out, values[:4] / values.sum()


def test_whitening_equals_brute_force(spark):
    from riskmart.llm.whitening import whiten
    rows = vectors()
    n, want, explained = whitening_brute(rows)
    df = table(spark, rows + [(1000 + i, v, 0) for i, v in enumerate(ODD)])
    got = whiten(df).collect()
    assert len(got) == 4 * len(rows) and {r.vec_id for r in got} == set(want)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    sign = {}
    for r in got:
        dev, w = want[r.vec_id]
        assert r.deviation == dev and abs(r.explained - explained[r.component - 1]) < 1e-9
        if abs(w[r.component - 1]) > 1e-6:
            s = np.sign(r.whitened * w[r.component - 1])
            assert sign.setdefault(r.component, s) == s
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
    again = {(r.vec_id, r.component): r.whitened for r in whiten(df.repartition(2)).collect()}
    assert all(again[r.vec_id, r.component] == r.whitened for r in got)  # however rows are dealt


def test_whitening_odd_tables(spark):
    from riskmart.llm.whitening import whiten
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, v, 0) for v in ODD] + [(2, [], 0)])).collect() == []
    one = whiten(table(spark, [(1, [0.5, -0.5, 2.0], 0), (1, [0.5, -0.5, 2.0], 0), (None, [0.5, -0.5, 2.0], 0)])).collect()
    assert len(one) == 9 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    line = whiten(table(spark, [(i, [i / 4, i / 2], 0) for i in range(9)])).collect()  # all variance on one component
    assert {r.component for r in line} == {1, 2}
    assert all((r.whitened is None) == (r.component == 2) for r in line) and {round(r.explained, 12) for r in line} == {1.0, 0.0}
    assert line[0].identity_error < 1e-9
    lengths = whiten(table(spark, [(i, [float(i % 5), float(i % 3)], 0) for i in range(20)] + [(50 + i, [float(i)], 0) for i in range(4)])).collect()
    assert {(r.vec_id >= 50, r.n, r.component) for r in lengths} == {(False, 15, 1), (False, 15, 2), (True, 4, 1)}
    huge = whiten(table(spark, [(1, [1e300, 1.0], 0), (2, [-1e300, 2.0], 0), (3, [0.0, 4.0], 0)])).collect()
    assert {r.deviation for r in huge} == {None, None} or all(r.deviation is None for r in huge if r.vec_id != 3)


# ------------------------------------------------------------------ op12
def neighbours_brute(rows, k=5):
    good = [(i, np.array(v, float)) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in good:
        if i is not None and i % 50 == 0:
            scores = [(-(v @ w) / math.sqrt((v @ v) * (w @ w)), j) for j, w in good if j != i and len(w) == len(v)]
            scores.sort(key=lambda s: (round(s[0], 12), s[1] is None, s[1] or 0))
            out[i] = scores[:k]
    return out


def test_small_shards_are_exact(spark):
    from riskmart.llm.hnsw import build_index, search_index
    rows = vectors(600) + [(1000 + i, v, 0) for i, v in enumerate(ODD + [[], [0.0] * 8, [1.0, 2.0]])]
    df = table(spark, rows + rows[:3])  # repeated rows count once
    got = search_index(build_index(df, shard_scale=20), df.where("vec_id % 50 = 0")).collect()
    want = neighbours_brute(rows)
    found = defaultdict(dict)
    for r in got:
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(found) == set(want)
    for q, near in want.items():
        assert [found[q][i + 1][0] for i in range(5)] == [j for _, j in near], q
        assert all(abs(found[q][i + 1][1] + s) < 1e-12 for i, (s, _) in enumerate(near))


@pytest.mark.parametrize("near_copies", [0, 1500])
def test_graph_recall(near_copies):
    from riskmart.llm.hnsw import build, search, unreached
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 24))
    if near_copies:  # one group that fills the lists of its members
        x[:near_copies] = x[0] + rng.normal(size=(near_copies, 24)) * 0.01
    u = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)[rng.permutation(4000)]
    layers = build(u)
    assert [len(a) for a in layers] == [4000, 250] and all(a.max() < len(a) for a in layers)
    loose = unreached(layers)
    ids, scores = search(u, layers, loose, u[:200], 64)
    exact = u[:200] @ u.T
    best = np.sort(exact, axis=1)[:, ::-1][:, :6]
    hits = (scores[:, :6] >= best[:, 5:] - 1e-6).mean()
    assert hits >= 0.95, hits
    assert np.allclose(np.take_along_axis(exact, ids[:, :6], 1), scores[:, :6], atol=1e-5)


def test_unreached_nodes_are_searched():
    from riskmart.llm.hnsw import build, search, unreached
    rng = np.random.default_rng(9)
    u = rng.normal(size=(1200, 8)).astype(np.float32)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    layers = build(u)
    for links in layers:  # no list names nodes 700 and 701 any more
        links[(links == 700) | (links == 701)] = -1
    loose = unreached(layers)
    assert {700, 701} <= set(loose.tolist())
    ids, _ = search(u, layers, loose, u[700:702], 32)
    assert ids[:, 0].tolist() == [700, 701]


def test_graph_shards_and_query_blocks(spark):
    from riskmart.llm.hnsw import build_index, search_index
    rows = vectors(3000, 16)
    df = table(spark, rows, "float")
    index = build_index(df)
    assert index.count() == 2 and sum(len(r.ids) for r in index.select("ids").collect()) == 3000
    got = search_index(index, df.where("vec_id % 50 = 0"), query_bytes=3000).collect()
    want = neighbours_brute([(i, np.array(v, np.float32).astype(float).tolist(), label) for i, v, label in rows])
    assert len(got) == 5 * len(want)
    worst = {q: -near[-1][0] for q, near in want.items()}
    assert np.mean([r.score >= worst[r.query_id] - 1e-9 for r in got]) >= 0.95


def test_search_odd_tables(spark):
    from riskmart.llm.hnsw import build_index, search_index
    none = table(spark, [])
    some = table(spark, [(0, [1.0, 0.0], 0), (50, [2.0, 0.0], 0), (None, [1.0, 1.0], 0), (3, [0.0, 1.0], 0), (4, [0.0, 5.0], 0)])
    assert search_index(build_index(none), none).collect() == []
    assert search_index(build_index(some), none).collect() == []
    assert search_index(build_index(none), some).collect() == []
    got = search_index(build_index(some), some.where("vec_id % 50 = 0")).collect()
    assert {(r.query_id, r.rank): r.vec_id for r in got} == {(0, 1): 50, (0, 2): None, (0, 3): 3, (0, 4): 4, (50, 1): 0, (50, 2): None, (50, 3): 3, (50, 4): 4}
    texts = some.where("vec_id is not null").withColumn("vec_id", some.vec_id.cast("string"))
    got = search_index(build_index(texts), texts, k=1).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {("0", "50"), ("50", "0"), ("3", "4"), ("4", "3")}


# ------------------------------------------------------------------ op13
def codes_brute(rows, parts=4, entries=256, rounds=4):
    rows = sorted(((i, [math.floor(1024 * c) for c in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(rows[0][1])
    at = [dim * j // parts for j in range(parts + 1)]
    codes, errors, books = [], [0] * len(rows), []
    for j in range(parts):
        p = [r[1][at[j]:at[j + 1]] for r in rows]
        book = [list(v) for v in p[:entries]]

        def assign():
            return [min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book)) for v in p]

        for _ in range(rounds):
            sums = defaultdict(list)
            for v, (_, e) in zip(p, assign()):
                sums[e].append(v)
            for e, vs in sums.items():
                book[e] = [sum(c) // len(vs) for c in zip(*vs)]
        found = assign()
        codes.append([e for _, e in found])
        errors = [a + d for a, (d, _) in zip(errors, found)]
        books.append(book)
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    by_label = defaultdict(int)
    for r, e in zip(rows, errors):
        by_label[r[2]] += e
    return sorted((str(r[0]), "".join(f"{c[k]:02x}" for c in codes), errors[k], by_label[r[2]], digest) for k, r in enumerate(rows))


def coded(df, **options):
    from riskmart.llm.vector_codes import compress
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(df, **options).collect())


def test_codes_equal_brute_force_and_sql(spark):
    from riskmart.llm.vector_codes import OP13_SQL
    rows = vectors()
    want = codes_brute(rows)
    df = table(spark, rows + [(1000 + i, v, 0) for i, v in enumerate(ODD)])
    assert coded(df) == want
    con = duckdb.connect()
    con.register("embeddings", df.select("vec_id", "embedding", "label").toArrow())
    got = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({OP13_SQL})").fetchall()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


@pytest.mark.parametrize("entries,bounds,parts", [(40, 4, 4), (40, 0, 4), (7, 16, 3), (1, 4, 4)])
def test_codes_with_few_entries_and_bounds(spark, entries, bounds, parts):
    rows = vectors(300, 10, seed=entries) + [(9, [0.0] * 10, 1), (9, [0.0] * 10, 1), (9, [0.25] * 10, 1), (None, [0.5] * 10, None)]
    assert coded(table(spark, rows), entries=entries, start_bounds=bounds, parts=parts) == codes_brute(rows, parts, entries)


def test_bounds_hold_and_save_work():
    from riskmart.llm import vector_codes as V
    rng = np.random.default_rng(4)
    p = np.floor(rng.normal(size=(3000, 6)) * 200 + rng.integers(0, 12, size=(3000, 1)) * 400).astype(np.int64)
    c, b = p[:100].copy(), 8
    state, full = V.compare_all(p, c, b), []
    for _ in range(6):
        d = ((p[:, None] - c[None]) ** 2).sum(axis=2)
        assert (state["entry"] == d.argmin(axis=1)).all()
        root, outside = np.sqrt(d), np.ones(d.shape, bool)
        near = state["near"].astype(int)
        assert (np.take_along_axis(root, near, 1) >= np.where(np.isfinite(state["low"]), state["low"], 0)).all()
        np.put_along_axis(outside, near, False, 1)
        outside[np.arange(len(p)), state["entry"]] = False
        assert (np.where(outside, root, np.inf).min(axis=1) >= state["outer"]).all()
        full.append((state["needed"] == 255).mean())
        assert (V._unpack(V._pack([state, state]), [b, b])[1] == state).all()
        new = np.array([p[state["entry"] == e].sum(axis=0) // max((state["entry"] == e).sum(), 1) if (state["entry"] == e).any() else c[e] for e in range(100)])
        drift = np.sqrt(V.exact_squares(new, c).astype(float)) * V._UP
        used = dict(zip(*np.unique(state["needed"], return_counts=True)))
        c, b = new, V.adapted({int(n): int(v) for n, v in used.items()}, b)
        state = V.next_state(p, c, drift, state, b)
    assert full[0] == 1 and max(full[1:]) < 0.4 and b < 8, (full, b)
    assert V.adapted({0: 50, 1: 98, 3: 1, 6: 1, 255: 40}, 8) == 4 and V.adapted({1: 94, 5: 6}, 8) == 5 and V.adapted({1: 100}, 4) == 2 and V.adapted({0: 9, 255: 1}, 8) == 8


def test_codes_odd_tables(spark):
    assert coded(table(spark, [])) == []
    assert coded(table(spark, [(1, v, 0) for v in ODD])) == []
    few = [(2, [1.0, 2.0, 3.0, 4.0], None), (1, [1.0, 2.0, 3.0, 4.0], None), (3, [-1.0, 0.0, -0.0, 9.5], 1)]
    assert coded(table(spark, few)) == codes_brute(few)
    short = [(1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0)]
    assert coded(table(spark, short)) == codes_brute(short)
    assert [r[1:4] for r in coded(table(spark, [(1, [], 0)]))] == [("00000000", 0, 0)]
    both = coded(table(spark, few + [(10, [5.0] * 8, 7)]))
    assert len(both) == 4 and len({r[4] for r in both}) == 2
    huge = [(1, [2.0 ** 40] * 4, 0), (2, [1.0, 2.0, 3.0, 4.0], 0), (3, [2.0 ** 40 + 1] * 4, 0), (4, [1.0, 2.5, 3.0, 4.0], 0)]
    assert [r[1] for r in coded(table(spark, huge), entries=2)] == [r[1] for r in codes_brute(huge, entries=2)]
    assert {r[1] for r in coded(table(spark, huge + [(5, [1e300] * 4, 0)]), entries=2)} <= {"00000000", "01010101"}
