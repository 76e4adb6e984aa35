"""op11: embedding whitening by mixed-precision eigenvector refinement.

Entries become integers floor(scale * c).  The fit list is each distinct integer vector
once.  Tasks add its integer products, centred by the mean's nearest integers, as exact
blocks (a block's sums stay below 2^53, totals are kept in extended precision); the part
of the mean below one is taken off in closed form, so the covariance does not depend on
how rows are dealt and is exact before its last rounding.

The eigenvectors of the covariance are first computed in float32.  Ogita-Aishima steps,
which are matrix products only, then correct them in double and at last in extended
precision: with R = I - X'X and S = X'AX, the correction X E has

    E_ij = (S_ij + l_j R_ij) / (l_j - l_i)   for separated eigenvalues,   R_ij / 2 otherwise.

Eigenvalues closer than the step's own error bound form a cluster: their columns span the
right space but are mixed within it.  Each cluster is solved on its own as the small matrix
V'(A - mu I)V, whose entries are as large as the cluster is wide, and turned by its
eigenvectors; the next steps then see the cluster apart.

Rows are projected in the JVM.  Vectors of different lengths are fits of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, materialize, ship, slices, table

SCALE, COMPONENTS = 256, 4
WIDE = np.longdouble
_MOST_STEPS = 12  # of each precision; convergence is quadratic and takes 2 to 4


# ------------------------------------------------------------------ eigenvectors
def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def refinement_step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step in the precision of ``a``: (vectors, values, gap bound, size of the correction)."""
    one = np.eye(len(a), dtype=a.dtype)
    r = one - x.T @ x
    s = _symmetric(x.T @ (a @ x))
    values = np.diag(s) / (1 - np.diag(r))
    residual = s - np.diag(values)
    bound = 2 * (np.sqrt((residual * residual).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > bound
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, bound, float(np.abs(e).max())


def clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Groups of at least two places whose values follow each other within ``bound``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def solve_cluster(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The columns ``v`` of a cluster turned to eigenvectors within their space."""
    av = a @ v
    mu = (v * av).sum() / (v * v).sum()
    small = _symmetric(v.T @ (av - mu * v))
    size = np.abs(small).max()
    if size <= len(a) * np.finfo(a.dtype).eps * np.abs(a).max():  # one value: any basis will do
        return v
    _, turn = np.linalg.eigh((small / size).astype(np.float64))
    return v @ turn.astype(a.dtype)


def refined_eigh(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of a symmetric matrix, falling values, in extended precision."""
    a = _symmetric(a.astype(WIDE))
    size = np.abs(a).max() if a.size else 0
    if not size:
        return np.zeros(len(a), WIDE), np.eye(len(a), dtype=WIDE)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, WIDE):
        b, x, least = a.astype(kind), x.astype(kind), np.inf
        for _ in range(_MOST_STEPS):
            x, values, bound, moved = refinement_step(b, x)
            groups = clusters(values, bound)
            for g in groups:
                x[:, g] = solve_cluster(b, x[:, g])
            if moved <= 4 * np.finfo(kind).eps or (not groups and moved >= least and moved < 1e-8):
                break
            least = min(least, moved)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


# ------------------------------------------------------------------ sums of the fit list
def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims):
        rows = batch.column(column) if (dims == dim).all() else batch.column(column).filter(pa.array(dims == dim))
        yield int(dim), rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the columns of int64 rows as Python integers."""
    most = max(int(x.max()), -int(x.min()))
    return (x.sum(axis=0) if most * len(x) < 1 << 62 else x.astype(object).sum(axis=0)).astype(object)


def products(z: np.ndarray) -> np.ndarray:
    """z'z of integer-valued doubles; exact while the block sums stay below 2^53."""
    most = float(np.abs(z).max()) ** 2
    step = len(z) if most >= 2 ** 52 else max(1, int(2 ** 53 // max(most, 1.0)))
    total = np.zeros((z.shape[1],) * 2, WIDE)
    for at in range(0, len(z), step):
        total += z[at:at + step].T @ z[at:at + step]
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in slices(batches, 4096):
        for dim, x in _by_length(batch, "x"):
            n, s = held.get(dim, (0, 0))
            held[dim] = n + len(x), s + exact_sums(x)
    for dim, (n, s) in held.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([dim], pa.int32()), pa.array([n], pa.int64()),
            pa.array([[Decimal(int(v)) for v in s]], pa.list_(pa.decimal128(38, 0)))], names=["dim", "n", "s"])


def _product_rows(dim: int, total: np.ndarray, places: Iterator[int]) -> pa.RecordBatch:
    high = total.astype(np.float64)
    low = (total - high).astype(np.float64)
    return pa.RecordBatch.from_pydict({
        "dim": pa.array([dim] * len(total), pa.int32()), "i": pa.array(list(places), pa.int32()),
        "high": pa.array(high.tolist(), pa.list_(pa.float64())), "low": pa.array(low.tolist(), pa.list_(pa.float64()))})


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in slices(batches, 4096):
        for dim, z in _by_length(batch, "z"):
            held[dim] = held.get(dim, 0) + products(z)
    for dim, total in held.items():
        yield _product_rows(dim, total, range(dim))


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, i, high, low) in order of (dim, i), added up one key at a time."""
    last, total = None, None
    for batch in batches:
        keys = zip(batch["dim"].to_pylist(), batch["i"].to_pylist())
        for at, key in enumerate(keys):
            row = np.asarray(batch["high"][at].values, np.float64).astype(WIDE) + np.asarray(batch["low"][at].values, np.float64)
            if key != last:
                if last is not None:
                    yield _product_rows(last[0], total[None, :], [last[1]])
                last, total = key, row
            else:
                total = total + row
    if last is not None:
        yield _product_rows(last[0], total[None, :], [last[1]])


MODEL = ("dim int, n long, centre array<double>, below array<double>, s array<decimal(38,0)>, "
         "parts array<struct<component: int, value: double, explained: double, vector: array<double>>>")


def _solver(components: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():  # one row a length
                n, s, centre = row["n"], [int(v) for v in row["s"]], [int(c) for c in row["centre"]]
                below = np.array([WIDE(t - c * n) for t, c in zip(s, centre)], WIDE) / n  # the mean less its centre
                held = sorted(row["products"], key=lambda r: r["i"])
                second = np.array([r["high"] for r in held], WIDE) + np.array([r["low"] for r in held], WIDE)
                cov = second / n - below[:, None] * below[None, :]
                values, vectors = refined_eigh(cov)
                trace, least = np.trace(cov), values[0] * len(s) * 2.0 ** -50
                parts = []
                for k in range(min(components, len(s))):
                    v = vectors[:, k].astype(np.float64)
                    live = values[k] > max(least, 0)
                    parts.append({"component": k + 1, "value": float(values[k]) if live else 0.0,
                                  "explained": float(max(values[k], 0) / trace) if trace > 0 else None,
                                  "vector": (v if v[np.abs(v).argmax()] > 0 else -v).tolist()})
                yield pa.RecordBatch.from_pylist(
                    [{"dim": row["dim"], "n": n, "centre": row["centre"], "below": [float(b) for b in below], "s": row["s"], "parts": parts}],
                    schema=pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("centre", pa.list_(pa.float64())), ("below", pa.list_(pa.float64())),
                                      ("s", pa.list_(pa.decimal128(38, 0))),
                                      ("parts", pa.list_(pa.struct([("component", pa.int32()), ("value", pa.float64()), ("explained", pa.float64()),
                                                                    ("vector", pa.list_(pa.float64()))])))]))
    return solve


# ------------------------------------------------------------------ the operator
def finite(vector: Column) -> Column:
    """Neither null nor with null or non-finite entries."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * entry), each entry taken as double; beyond a long, the nearest long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def _centred(x: Column, centre: Column) -> Column:
    return F.zip_with(x, centre, lambda a, c: a.cast("double") - c)


def _projected(z: Column, part: Column) -> Column:
    """(x - mean) on the component, over the root of its eigenvalue; null without variance."""
    along = F.aggregate(F.zip_with(z, part["vector"], lambda a, v: a * v), F.lit(0.0), lambda t, v: t + v)
    return F.when(part["value"] > 0, along / F.sqrt(part["value"]))


def whitening_model(x: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, DataFrame]:
    """(fit list, model) of a table (dim, x): the model is a row for each length with components by falling eigenvalue."""
    ship(x.sparkSession)
    fit = materialize(x.select("dim", "x").where("dim > 0").distinct(), "white-fit")
    sums = fit.mapInArrow(_sums, "dim int, n long, s array<decimal(38,0)>").select("dim", "n", F.posexplode("s").alias("i", "v"))
    sums = sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("v").cast("decimal(38,0)").alias("v"))
    means = sums.groupBy("dim").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda r: r["v"]).alias("s"))
    means = materialize(means.withColumn("centre", F.transform("s", lambda v: F.round(v.cast("double") / F.col("n")))), "white-means")
    centred = fit.join(broadcast_below(means.select("dim", "centre")), "dim").select("dim", _centred(F.col("x"), F.col("centre")).alias("z"))
    rows = "dim int, i int, high array<double>, low array<double>"
    added = centred.mapInArrow(_products, rows).repartition("dim", "i").sortWithinPartitions("dim", "i").mapInArrow(_add_up, rows)
    whole = added.groupBy("dim").agg(F.collect_list(F.struct("i", "high", "low")).alias("products"))  # dim rows a length
    model = materialize(means.join(whole, "dim").mapInArrow(_solver(components), MODEL), "white-model")
    return fit, model


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Rows whose vector is null or holds a null or non-finite entry are left out; an empty vector
    has no components.  Repeated rows and rows with a null id come back as often as they come
    in.  A vector of fewer than ``components`` entries has as many components as entries.  A
    component without variance (equal vectors, a single one) has a null ``whitened`` and is left
    out of ``identity_error``, which is null if no component is left; ``explained`` is null if
    nothing varies.  ``deviation`` is null where it is no long.  Other columns are not read.
    """
    vector = F.col(vector_col)
    rows = df.select(F.col(id_col).alias("row_id"), vector.alias("vector")).where(finite(F.col("vector"))).select(
        "row_id", F.size("vector").alias("dim"), whole_numbers(F.col("vector"), scale).alias("x"))
    fit, model = whitening_model(rows, components)
    lengths = broadcast_below(model)
    offset = F.zip_with(_centred(F.col("x"), F.col("centre")), "below", lambda a, b: a - b)

    names = [f"w{k}" for k in range(components)]
    projected = fit.join(lengths, "dim").select("dim", "parts", offset.alias("z")).select(
        "dim", *[_projected(F.col("z"), F.get("parts", F.lit(k))).alias(w) for k, w in enumerate(names)])
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    spread = projected.groupBy("dim").agg(*[F.covar_pop(names[a], names[b]).alias(f"c_{a}_{b}") for a, b in pairs])
    misses = [F.abs(F.col(f"c_{a}_{b}") - F.lit(1.0 if a == b else 0.0)) for a, b in pairs]
    error = materialize(spread.select("dim", (F.greatest(*misses) if len(misses) > 1 else misses[0]).alias("identity_error")), "white-error")

    known = model.join(error, "dim", "left").withColumn("s", F.transform("s", lambda v: v.try_cast("long")))
    n = F.col("n")
    distance = F.zip_with("x", "s", lambda a, s: F.try_subtract(F.try_multiply(a, n), s))
    deviation = F.aggregate(distance, F.lit(0).cast("long"), lambda t, v: F.try_add(t, F.try_multiply(v, v)))
    out = rows.join(broadcast_below(known), "dim").select(
        "row_id", "n", deviation.alias("deviation"), "identity_error", offset.alias("z"), F.explode("parts").alias("part"))
    return out.select(F.col("row_id").alias(id_col), F.col("part.component").alias("component"), "n", "deviation",
                      _projected(F.col("z"), F.col("part")).alias("whitened"), F.col("part.explained").alias("explained"), "identity_error")


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """All ``embeddings`` on the four widest components of their integer vectors."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
