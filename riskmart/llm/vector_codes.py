"""op13: vector code compression (product quantisation) with Drake-Hamerly adaptive bounds.

Vectors become integers floor(scale * x) and are cut into equal consecutive parts; every
part position has a codebook of at most 256 entries, fitted in a few rounds of nearest-entry
assignment and integer means.  Assignments are those of plain k-means to the last bit: all
decisions are taken on whole-number distances.

Between rounds each part keeps its entry, the b next closest entries with lower bounds of
their distances in order, and one outer bound below the distance of every other entry.  When
the entries have moved by known drifts, lower bounds fall by the drift of their entry and the
outer bound by the largest drift among the others.  With u the part's new distance to its
entry, taken exactly,

    u below all bounds        the entry stays and no other distance is computed
    u below the outer bound   only the b kept entries are compared, in whole numbers
    otherwise                 all entries are compared, and the lists are made anew

so ties, and whatever the bounds leave uncertain, are settled by integers.  b starts at
``START_BOUNDS`` and after every round falls to the number of bounds that 99% of the parts of
the position that used their list needed, by half at most; bounds that go lower the outer bound.

The state is a column of the written table (a round's table replaces the one before), so a
round is one narrow pass and a lost executor repeats only its own tasks.  Tasks add up their
parts by entry; sums combine by (position, entry, component).  Only codebooks come to the
driver.  A product of doubles is exact below 2^53; beyond it distances carry error bounds and
candidates within them are compared in Python integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, discard, fresh, materialize, new_path, ship, slices, table
from riskmart.llm.whitening import finite, whole_numbers

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
START_BOUNDS, LEAST_BOUNDS, SERVED = 16, 2, 0.99
_ALL = 255  # "needed" of a part that was compared with all entries
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12
#: Codebooks of so many bytes travel together (vectors of many lengths are fitted in groups of lengths).
MODEL_BYTES = 16 << 20


# ------------------------------------------------------------------ distances
def squares(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Squared distances of all rows to all entries, and their error bounds (None: exact whole numbers)."""
    pf, cf = p.astype(np.float64), c.astype(np.float64)
    pp, cc = (pf * pf).sum(axis=1), (cf * cf).sum(axis=1)
    d = pp[:, None] + cc[None, :] - 2 * (pf @ cf.T)
    if 4 * max(pp.max(initial=0), cc.max(initial=0)) < 2.0 ** 52:
        return d, None
    return np.maximum(d, 0), (8 * p.shape[1] + 16) * 2.0 ** -53 * (np.sqrt(pp)[:, None] + np.sqrt(cc)[None, :]) ** 2


def exact_squares(p: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number squared distances along the last axis; Python integers where a long might not do."""
    most = max((int(np.abs(a.astype(np.float64)).max(initial=0)) for a in (p, c))) + 1
    if (2 * most) ** 2 * max(p.shape[-1], 1) < 1 << 62:
        away = p - c
    else:
        away = p.astype(object) - c.astype(object)
    return (away * away).sum(axis=-1)


def nearest(p: np.ndarray, c: np.ndarray, d: np.ndarray, error: np.ndarray | None) -> np.ndarray:
    """The nearest entry of each row, the lower of equals."""
    first = d.argmin(axis=1)
    if error is not None:
        open_ = d - error <= (d + error).min(axis=1)[:, None]
        for i in np.flatnonzero(open_.sum(axis=1) > 1):
            those = np.flatnonzero(open_[i])
            first[i] = min((sum((int(a) - int(b)) ** 2 for a, b in zip(p[i], c[j])), j) for j in those)[1]
    return first


def _floor32(a: np.ndarray) -> np.ndarray:
    """float32 numbers at most as large."""
    low = a.astype(np.float32)
    return np.where(low > a, np.nextafter(low, np.float32(-np.inf)), low)


# ------------------------------------------------------------------ the state of a part
def state_type(b: int) -> np.dtype:
    return np.dtype([("entry", "u1"), ("needed", "u1"), ("near", "u1", (b,)), ("low", "<f4", (b,)), ("outer", "<f4")])


def compare_all(p: np.ndarray, c: np.ndarray, b: int) -> np.ndarray:
    """The state after a comparison with every entry."""
    k, out = len(c), np.zeros(len(p), state_type(b))
    d, error = squares(p, c)
    entry = nearest(p, c, d, error)
    lower = d if error is None else np.maximum(d - error, 0)
    if b + 2 < k:
        order = np.argpartition(lower, b + 1, axis=1)[:, :b + 2]
        lost = ~(order == entry[:, None]).any(axis=1)  # more than b + 1 entries as near
        order[lost, -1] = entry[lost]
    else:
        order = np.broadcast_to(np.arange(k), d.shape)
    order = order[order != entry[:, None]].reshape(len(p), -1)
    values = np.take_along_axis(lower, order, axis=1)
    rank = np.argsort(values, axis=1, kind="stable")
    order, values = np.take_along_axis(order, rank, axis=1), np.take_along_axis(values, rank, axis=1)
    low = _floor32(np.sqrt(values) * _DOWN)
    kept = min(b, order.shape[1])
    out["entry"], out["needed"] = entry, _ALL
    out["near"], out["low"] = entry[:, None], np.inf  # an unused place never binds
    out["near"][:, :kept], out["low"][:, :kept] = order[:, :kept], low[:, :kept]
    out["outer"] = low[:, kept] if low.shape[1] > kept else np.inf
    return out


def move_bounds(state: np.ndarray, drift: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(near, low, outer) after the entries moved by ``drift``, in order, with the ``b`` lowest kept."""
    near = state["near"]
    low = state["low"].astype(np.float64) - drift[near]
    # the largest drift of an entry outside the list: the first one in order of drift that the row does not hold
    fall, open_ = np.zeros(len(state)), np.ones(len(state), bool)
    for j in np.argsort(-drift, kind="stable")[:near.shape[1] + 2]:
        out = open_ & (state["entry"] != j) & (near != j).all(axis=1)
        fall[out] = drift[j]
        open_ &= ~out
    outer = state["outer"].astype(np.float64) - fall
    rank = np.argsort(low, axis=1, kind="stable")
    near, low = np.take_along_axis(near, rank, axis=1), np.take_along_axis(low, rank, axis=1)
    if b < near.shape[1]:
        outer = np.minimum(outer, low[:, b:].min(axis=1, initial=np.inf))
    return near[:, :b], low[:, :b], outer


def next_state(p: np.ndarray, c: np.ndarray, drift: np.ndarray, state: np.ndarray, b: int) -> np.ndarray:
    """The state after the entries moved to ``c``; assignments equal a comparison with all entries."""
    b = min(b, state["near"].shape[1])
    near, low, outer = move_bounds(state, drift, b)
    u = np.sqrt(exact_squares(p, c[state["entry"]]).astype(np.float64)) * _UP
    needed = (low <= u[:, None]).sum(axis=1)
    out = np.zeros(len(p), state_type(b))
    out["entry"], out["needed"], out["near"], out["low"], out["outer"] = state["entry"], needed, near, _floor32(low), _floor32(outer)
    listed = np.flatnonzero((needed > 0) & (u < outer))
    if len(listed):
        those = np.concatenate([state["entry"][listed, None], near[listed]], axis=1).astype(np.int64)
        d = exact_squares(p[listed, None, :], c[those])
        unused = np.concatenate([np.zeros((len(listed), 1), bool), ~np.isfinite(low[listed])], axis=1)
        best = np.where(unused, np.iinfo(np.int64).max if d.dtype != object else 1 << 200, d).min(axis=1)
        entry = np.where((d == best[:, None]) & ~unused, those, 256).min(axis=1)
        others = np.where(unused, np.inf, np.sqrt(d.astype(np.float64)) * _DOWN)
        place = those == entry[:, None]
        first = place.argmax(axis=1)  # the new entry leaves the list, the old one joins it
        others[np.arange(len(listed)), first] = -1
        rank = np.argsort(others, axis=1, kind="stable")[:, 1:]
        out["entry"][listed] = entry
        out["near"][listed] = np.take_along_axis(those, rank, axis=1)
        out["low"][listed] = _floor32(np.take_along_axis(others, rank, axis=1))
    full = np.flatnonzero(u >= outer)
    if len(full):
        out[full] = compare_all(p[full], c, b)
    return out


# ------------------------------------------------------------------ batches
def cuts(dim: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; equal ones if ``parts`` divides the length."""
    return [dim * i // parts for i in range(parts + 1)]


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    for batch in slices(batches, 4096):
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims):
            rows = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
            yield int(dim), rows, rows["x"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, int(dim))


def _unpack(column: pa.Array, bounds: Sequence[int]) -> list[np.ndarray]:
    types = [state_type(b) for b in bounds]
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    at, out = 0, []
    for t in types:
        out.append(np.ascontiguousarray(raw[:, at:at + t.itemsize]).view(t)[:, 0])
        at += t.itemsize
    return out


def _pack(states: Sequence[np.ndarray]) -> pa.Array:
    raw = np.concatenate([np.ascontiguousarray(s).view(np.uint8).reshape(len(s), -1) for s in states], axis=1)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def _assigner(books: dict, before: dict | None, held: dict | None, bounds: dict, last: bool):
    """Pass over (id, label, dim, x[, state]): the new states, or the codes and errors after the last round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch, x in _by_length(batches):
            at, states = cuts(dim, len(books[dim])), []
            old = _unpack(batch["state"], held[dim]) if held else None
            for j, book in enumerate(books[dim]):
                p = x[:, at[j]:at[j + 1]]
                if old is None:
                    states.append(compare_all(p, book, bounds[dim][j]))
                else:
                    drift = np.sqrt(exact_squares(book, before[dim][j]).astype(np.float64)) * _UP
                    states.append(next_state(p, book, drift, old[j], bounds[dim][j]))
            columns = [batch["id"], batch["label"]]
            if not last:
                yield pa.RecordBatch.from_arrays([*columns, batch["dim"], batch["x"], _pack(states)], names=["id", "label", "dim", "x", "state"])
                continue
            codes = np.stack([s["entry"] for s in states], axis=1)
            error = sum(exact_squares(x[:, at[j]:at[j + 1]], book[codes[:, j]]).astype(object) for j, book in enumerate(books[dim]))
            yield pa.RecordBatch.from_arrays([
                *columns, batch["dim"], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                pa.array([Decimal(int(e)) if e < 10 ** 38 else None for e in error], pa.decimal128(38, 0))], names=["id", "label", "dim", "code", "error"])
    return run


def _adder(parts: int, bounds: dict):
    """Pass over (dim, x, state): sums of the parts of each entry, and how many bounds parts needed (entry -1 - needed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for dim, batch, x in _by_length(batches):
            at = cuts(dim, parts)
            for j, state in enumerate(_unpack(batch["state"], bounds[dim])):
                p, order = x[:, at[j]:at[j + 1]], np.argsort(state["entry"], kind="stable")
                entries, start = np.unique(state["entry"][order], return_index=True)
                most = float(np.abs(p.astype(np.float64)).max(initial=0))
                rows = p[order] if most * len(p) < 2.0 ** 62 else p[order].astype(object)
                for e, n, s in zip(entries, np.diff([*start, len(p)]), np.add.reduceat(rows, start, axis=0)):
                    found = sums.setdefault((dim, j, int(e)), [0, 0])
                    found[0], found[1] = found[0] + int(n), found[1] + s.astype(object)
                for needed, n in zip(*np.unique(state["needed"], return_counts=True)):
                    sums.setdefault((dim, j, -1 - int(needed)), [0, np.zeros(0, object)])[0] += int(n)
        keys = list(sums)
        for start in range(0, len(keys), 1024):
            some = keys[start:start + 1024]
            yield pa.RecordBatch.from_arrays([
                *[pa.array([k[i] for k in some], pa.int32()) for i in range(3)], pa.array([sums[k][0] for k in some], pa.int64()),
                pa.array([[Decimal(int(v)) for v in sums[k][1]] for k in some], pa.list_(pa.decimal128(38, 0)))],
                names=["dim", "part", "entry", "n", "s"])
    return run


def adapted(used: dict[int, int], b: int) -> int:
    """The b that serves 99% of the parts which used their list: no larger than before, no smaller than half."""
    listed = {n: count for n, count in used.items() if 0 < n < _ALL}
    total, so_far = sum(listed.values()), 0
    for n in sorted(listed):
        so_far += listed[n]
        if so_far >= SERVED * total:
            return min(b, max(n, b // 2, LEAST_BOUNDS))
    return b


# ------------------------------------------------------------------ the operator
def _fit(rows: DataFrame, parts: int, entries: int, rounds: int, start_bounds: int) -> tuple[DataFrame, dict, list]:
    """(id, label, dim, code, error) of the rows, the codebooks of each length, and b by round."""
    spark = rows.sparkSession
    first = rows.select("dim", "id", "x").withColumn("at", F.row_number().over(
        Window.partitionBy("dim").orderBy(F.col("id").asc_nulls_last(), "x"))).where(F.col("at") <= entries)
    books: dict[int, list] = {}
    starts: dict[int, list] = {}
    for r in first.select("dim", "at", "x").collect():
        starts.setdefault(r.dim, []).append((r.at, r.x))
    for dim, found in starts.items():
        x = np.array([v for _, v in sorted(found)], np.int64).reshape(len(found), dim)
        at = cuts(dim, parts)
        books[dim] = [x[:, at[j]:at[j + 1]] for j in range(parts)]

    state = "id {0}, label {1}, dim int, x array<long>, state binary".format(
        rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString())
    bounds = {dim: [min(start_bounds, max(len(b[0]) - 1, 0))] * parts for dim, b in books.items()}
    history, before, held, current, path = [bounds], None, None, rows, None
    for _ in range(rounds):
        new = new_path(spark, "codes-state")
        current = materialize(current.mapInArrow(_assigner(books, before, held, bounds, False), state), "", new)
        if path:
            discard(spark, path)
        path, held = new, bounds
        sums = current.select("dim", "x", "state").mapInArrow(_adder(parts, held), "dim int, part int, entry int, n long, s array<decimal(38,0)>")
        sums = sums.select("dim", "part", "entry", "n", F.posexplode_outer("s").alias("at", "v")).groupBy("dim", "part", "entry", "at").agg(
            F.sum("n").alias("n"), F.sum("v").cast("decimal(38,0)").alias("v"))
        sums = sums.groupBy("dim", "part", "entry").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "v"))).alias("s"))
        before = books
        books = {dim: [b.copy() for b in book] for dim, book in books.items()}
        used: dict[tuple, dict] = {}
        for r in sums.collect():  # at most 256 entries and as many counts for each position and length
            if r.entry < 0:
                used.setdefault((r.dim, r.part), {})[-1 - r.entry] = r.n
            elif r.s and r.s[0].at is not None:
                books[r.dim][r.part][r.entry] = [int(v.v) // r.n for v in r.s]
        bounds = {dim: [adapted(used.get((dim, j), {}), b) for j, b in enumerate(bs)] for dim, bs in held.items()}
        history.append(bounds)
    codes = current.mapInArrow(_assigner(books, before, held, bounds, True),
                               state.replace("x array<long>, state binary", "code string, error decimal(38,0)"))
    return materialize(codes, "codes"), books, history


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, start_bounds: int = START_BOUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of each usable row.

    Rows whose vector is null or holds null or non-finite components are left out.  Vectors of
    different lengths have codebooks of their own; a length that ``parts`` does not divide is cut
    at the floors of its equal shares, so parts may be empty (distance 0, entry 0).  Fewer rows
    than ``entries`` make fewer entries.  Repeated rows count as often as they come; of equal ids
    the smaller vector comes first, null ids come last.  Null labels are one label.  Sums beyond
    a long are null.  Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry is written as two hex digits: 1 to 256 entries")
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")))
    rows = rows.select("id", "label", F.size("vector").alias("dim"), whole_numbers(F.col("vector"), scale).alias("x"))
    groups: list[list[int]] = [[]]
    taken = 0
    for r in rows.select("dim").distinct().orderBy("dim").collect():  # lengths, not rows
        if groups[-1] and taken + entries * r.dim * 8 > MODEL_BYTES:
            groups.append([])
            taken = 0
        groups[-1].append(r.dim)
        taken += entries * r.dim * 8
    done, digests = [], []
    for lengths in groups:
        codes, books, _ = _fit(rows if len(groups) == 1 else rows.where(F.col("dim").isin(lengths)), parts, entries, rounds, start_bounds)
        done.append(codes)
        digests += [(dim, hashlib.sha256(",".join(str(int(v)) for b in book for e in b for v in e).encode()).hexdigest()) for dim, book in books.items()]
    codes = reduce(DataFrame.unionByName, done)
    total = F.sum("error").cast("decimal(38,0)").try_cast("long").alias("label_error")
    sums = materialize(codes.groupBy(F.col("label").alias("sum_label")).agg(total), "codes-labels")
    digest = spark.createDataFrame(digests, "digest_dim int, codebooks_sha256 string")
    out = codes.join(broadcast_below(sums), F.col("label").eqNullSafe(F.col("sum_label"))).join(
        broadcast_below(digest), F.col("dim") == F.col("digest_dim"))
    return out.select(F.col("id").alias(id_col), F.col("label").alias(fresh(df.select(id_col), label_col)[0]), "code",
                      F.col("error").try_cast("long").alias("error"), "label_error", "codebooks_sha256")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all ``embeddings`` in four parts of 256 entries after four rounds."""
    return compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).drop("label")


def _round_sql(r: int) -> str:
    """CTEs a{r} (assignment to codebook c{r}) and c{r + 1} (its update)."""
    return f"""
a{r} AS MATERIALIZED (
  SELECT p.vec_id, p.j, any_value(p.x) AS x, min({{'d': p.xx - 2 * list_inner_product(p.f, c.f) + c.cc, 'e': c.e}}) AS best
  FROM p JOIN c{r} c ON p.j = c.j GROUP BY p.vec_id, p.j),
u{r} AS (
  SELECT j, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x
  FROM (SELECT j, e, pos, sum(val) AS s, count(*) AS n
        FROM (SELECT j, best.e AS e, unnest(x) AS val, generate_subscripts(x, 1) AS pos FROM a{r}) GROUP BY ALL) GROUP BY j, e),
c{r + 1} AS MATERIALIZED (
  SELECT j, e, x, x::DOUBLE[] AS f, list_inner_product(x::DOUBLE[], x::DOUBLE[]) AS cc
  FROM (SELECT c.j, c.e, coalesce(u.x, c.x) AS x FROM c{r} c LEFT JOIN u{r} u ON c.j = u.j AND c.e = u.e)),"""


OP13_SQL = f"""
WITH v AS (
  SELECT vec_id, label, [floor(1024 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR isnan(c) OR isinf(c)]) = 0),
p AS MATERIALIZED (
  SELECT vec_id, j, x, x::DOUBLE[] AS f, list_inner_product(x::DOUBLE[], x::DOUBLE[]) AS xx
  FROM (SELECT vec_id, j, x[j * (len(x) // 4) + 1:(j + 1) * (len(x) // 4)] AS x FROM v, range(4) t(j))),
c0 AS MATERIALIZED (
  SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, x, f, xx AS cc
  FROM p QUALIFY row_number() OVER (PARTITION BY j ORDER BY vec_id) <= 256),
{"".join(_round_sql(r) for r in range(ROUNDS))}
a AS (
  SELECT p.vec_id, p.j, min({{'d': p.xx - 2 * list_inner_product(p.f, c.f) + c.cc, 'e': c.e}}) AS best
  FROM p JOIN c{ROUNDS} c ON p.j = c.j GROUP BY p.vec_id, p.j),
coded AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY j) AS code, sum(best.d)::BIGINT AS error FROM a GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(val::VARCHAR, ',' ORDER BY j, e, pos)) AS codebooks_sha256
  FROM (SELECT j, e, unnest(x) AS val, generate_subscripts(x, 1) AS pos FROM c{ROUNDS}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), books
"""
