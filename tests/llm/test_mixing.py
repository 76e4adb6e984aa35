"""op5: mixing against brute force."""
import bisect
import hashlib
import math
import random


def mix_brute(rows, weights=(3, 1, 2), share=1.5, most=2):
    from fractions import Fraction
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, Fraction(share) * sum(size.values()), set(order)
    while open_:  # excess goes round by weight until no source is above its limit
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * size[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = Fraction(most * size[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return size, {s: float(t) for s, t in target.items()}


def test_mixing_meets_targets_and_repeats(spark):
    from riskmart.llm.mixing import mix_sources
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([0, 1, 3, 20, 50]), rng.choice(["hot"] * 6 + ["a", "b", None, "é", "Z"])) for i in range(900)]
    rows += [(None, "x y", "a"), (None, "x y", "a"), (None, "p q r", "a"), (7, None, "b"), (8, "tie tie", "b"), (8, "tie tie", "b"), (9, "w " * 30_000, "long"), (10, "", "empty")]
    df = spark.createDataFrame([(i, t, s, "x") for i, t, s in rows], "doc_id long, text string, source string, size string").repartition(4)
    got = mix_sources(df, keep=["doc_id", "source"])
    first = sorted(map(str, got.collect()))
    assert first == sorted(map(str, mix_sources(df.repartition(7), keep=["doc_id", "source"]).collect())) and len(first) == len(rows)
    size, target = mix_brute(rows)
    taken = {}
    for r in got.collect():
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= (1 if s != "long" else 15_000)
    wide = mix_sources(df)
    assert wide.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    assert sorted(map(str, wide.select(*got.columns).collect())) == first
    assert mix_sources(df.limit(0)).count() == 0


def test_mixing_needs_no_python(spark):
    from riskmart.llm.mixing import mix_sources
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mix_sources(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian"))


def greedy(sizes, order, words, target, tolerance):
    """Down the order every document that fits, in runs, and the closing document after the best run."""
    taken, runs, left, at = set(), [], words, 0
    while True:
        most, stop = left, None
        for j in range(at, len(order)):
            d = order[j]
            if sizes[d] > most:  # larger than what was left when the run began
                continue
            if sizes[d] > left:
                stop = j
                break
            taken.add(d)
            left -= sizes[d]
        runs.append((left, set(taken)))
        if stop is None or left <= tolerance * target or not any(sizes[d] <= left for d in order[stop + 1:]):
            break
        at = stop + 1
    best = []
    for n, (gap, held) in enumerate(runs):
        close = min(((abs(gap - sizes[d]), j) for j, d in enumerate(order) if d not in held and abs(gap - sizes[d]) < gap), default=None)
        best.append((close[0] if close else gap, n, held | ({order[close[1]]} if close else set())))
    return min(best, key=lambda b: b[:2])[2], len(runs)


def unit(doc_id):
    return (int(hashlib.md5(f"mix:{doc_id}:".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52


def test_mixing_equals_a_greedy_pass(spark):
    """Document by document down the Pareto order."""
    from riskmart.llm.mixing import mix_sources
    rng = random.Random(7)
    rows = [(i, rng.choice([0, 1, 3, 10, 60, 400, 2500]), rng.choice("abc")) for i in range(500)]
    rows += [(1000 + k, max(1, int(1.12 ** k)), "hard") for k in range(80)]
    rows += [(5000 + i, 7, None) for i in range(30)]
    df = spark.createDataFrame([(i, "w " * n, s) for i, n, s in rows], "doc_id long, text string, source string").repartition(6)
    most_runs = 0
    for tolerance in (0.0, 0.05):
        got = {r.doc_id: r for r in mix_sources(df, keep=["doc_id", "source"], weights=(2, 3, 5, 1, 4), tolerance=tolerance).collect()}
        assert len(got) == len(rows)
        for source in ("a", "b", "c", "hard", None):
            sizes = {i: n for i, n, s in rows if s == source}
            total, target = sum(sizes.values()), got[next(iter(sizes))].target
            whole = math.floor(target / total)
            part, words, mean = target / total - whole, target - whole * total, total / len(sizes)

            def place(i):
                inclusion = min(0.98, max(0.02, part * math.sqrt(sizes[i] / mean)))
                return (unit(i) / (1 - unit(i))) * ((1 - inclusion) / inclusion), unit(i), sizes[i]

            live = sorted((i for i in sizes if sizes[i] and words > 0), key=place)
            sample, runs = greedy(sizes, live, words, target, tolerance)
            most_runs = max(most_runs, runs)
            assert {i: got[i].copies for i in sizes} == {i: (whole + (i in sample)) if sizes[i] else 0 for i in sizes}, (source, tolerance)
            assert all(got[i].taken == got[i].copies * sizes[i] <= 2 * sizes[i] for i in sizes)
    assert most_runs >= 4, most_runs


def test_a_source_that_needs_twenty_runs(spark):
    """Ids are chosen for their random numbers, so that every other document is a little too large for what is left."""
    from riskmart.llm.mixing import mix_sources
    pool = sorted((unit(i), i) for i in range(60_000))
    words, sizes = 1000, []
    for k in range(1, 26):
        sizes += [10, words - 10 * k + 5]
    total = sum(sizes)
    part, mean = words / total, total / len(sizes)
    rows = []
    for k, size in enumerate(sizes):
        inclusion = min(0.98, max(0.02, part * math.sqrt(size / mean)))
        odds = 0.2 * (k + 1) * inclusion / (1 - inclusion)
        u, i = pool[bisect.bisect(pool, (odds / (1 + odds), 0))]
        rows.append((i, size))
    assert len(dict(rows)) == 50
    df = spark.createDataFrame([(i, "w " * n, "s") for i, n in rows], "doc_id long, text string, source string")
    sample, runs = greedy(dict(rows), [i for i, _ in rows], part * total, part * total, 0.0005)
    assert runs >= 20
    got = {r.doc_id: r.copies for r in mix_sources(df, keep=["doc_id"], share=part).collect()}
    assert got == {i: int(i in sample) for i, _ in rows}


def test_mixing_goes_on_past_documents_that_do_not_fit(spark):
    from pyspark.sql import functions as F

    from riskmart.llm.mixing import TOLERANCE, mix_sources
    rng = random.Random(5)
    rows = [(i, "w " * 100, "long") for i in range(1000)] + [(5000, "w " * 100_000, "long")]
    rows += [(10_000 + i, "w " * rng.choice([1, 2, 5, 40, 300, 4000]), rng.choice(["a", "b", "c"])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mix_sources(df, keep=["doc_id", "source"], weights=(4, 2, 1, 3), tolerance=0.0).collect()
    assert len(got) == len(rows)
    for source in ("a", "b", "c", "long"):
        mine = [r for r in got if r.source == source]
        gap = mine[0].target - sum(r.taken for r in mine)
        assert abs(gap) <= 1 if source != "long" else abs(gap) <= 50
    assert sorted(map(str, got)) == sorted(map(str, mix_sources(df.repartition(7), keep=["doc_id", "source"], weights=(4, 2, 1, 3), tolerance=0.0).collect()))
    one = mix_sources(df.where("doc_id < 3"), tolerance=0.0)
    assert one.count() == 3
    near = mix_sources(df, keep=["doc_id", "source"], weights=(4, 2, 1, 3)).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"))
    assert all(abs(r.target - r.taken) <= max(50, TOLERANCE * r.target) for r in near.collect())
