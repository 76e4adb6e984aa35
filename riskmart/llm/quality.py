"""op8: quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text.  Preference pairs (a document
labelled 1 over one labelled 0) are fitted by the logistic loss of the difference of their
features, so only the order of scores is learnt.  The cut is a quantile of the training
scores; scores are mapped so that the cut is at ``cut_score``.

The fit uses at most about ``max_labelled`` labelled rows (a documented bound, chosen by a
hash of the id); scoring reads every document.  Labels, language, source and id are never
features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import fresh, materialize, ship, slices, table, texts

MAX_LABELLED, PAIRS_EACH, CUT_SCORE = 20_000, 12, 0.3

_SYMBOLS = b"#$%&*@^~<>{}[]\\/=+_|"
_CLASS = np.full(256, 8, np.int64)  # other control bytes
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                      (b" \t\r\x0b\x0c", 3), (b"\n", 4), (b".,;:?'\"()-", 5), (b"!", 6), (_SYMBOLS, 7)):
    _CLASS[list(_chars)] = _kind
_CLASS[128:] = 9
SHARES = ("lower", "upper", "digit", "space", "line", "stop", "bang", "symbol", "control", "high")
N_FEATURES = 30


def text_features(text: str) -> list[float]:
    """Features of a whole text; those of an empty text are all 0 but the first."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [1.0] + [0.0] * (N_FEATURES - 1)
    n = len(words)
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10).astype(float)
    letters = counts[0] + counts[1] + counts[9]
    share = counts / len(raw)
    distinct = len({w.lower() for w in words})
    again = sum(map(bytes.__eq__, words, words[1:])) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines)
    marked = sum(w[-1] in b"*$%&#!|" for w in words) / n
    shouted = sum(map(bytes.isupper, words)) / n
    length = len(raw) / n - 1
    values = [0.0, *share.tolist(), counts[1] / max(letters, 1), letters / len(raw), distinct / n,
              again, repeated, marked, shouted, min(length, 40) / 10, min(n, 20) / 20]
    # where a little of something already tells: roots of the shares of junk
    return values + [math.sqrt(x) for x in (share[7], share[6], share[1], share[2], again, repeated, marked, shouted)] + [
        math.log(n) / 10, distinct / n / math.log(n + 1)]


def features(df: DataFrame, text_col: str, keep: list[str], out: str = "features") -> DataFrame:
    """``keep`` columns and the feature array of every whole text."""
    ship(df.sparkSession)
    source = df.select(*keep, F.col(text_col).alias(fresh(df.select(*keep), "text_to_score")[0]))
    schema = df.select(*keep).schema.add(out, T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [text_features(t) for t in texts(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return source.mapInArrow(run, schema)


def id_crc(col: str | Column) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) if isinstance(col, str) else F.crc32(col.cast("string").cast("binary"))


class Ranking:
    """A fitted ranking: standardisation, weights, cut and slope of the map to [0, 1]."""

    def __init__(self, mean, scale, weights, cut: float, cut_score: float):
        self.mean, self.scale, self.weights = (np.asarray(x, float) for x in (mean, scale, weights))
        self.cut, self.shift = cut, math.log(cut_score / (1 - cut_score))

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not np.any(self.weights):
            return np.full(len(rows), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.raw(rows) - self.cut + self.shift, -40, 40)))


def fit_ranking(labelled: DataFrame, label_col: str, id_col: str, text_col: str, max_labelled: int = MAX_LABELLED,
                pairs_each: int = PAIRS_EACH, cut_score: float = CUT_SCORE, reg: float = 1e-4) -> Ranking:
    """Fit on (id, text, label) rows; rows without a label of 0 or 1 are left out.

    With no pair (one class or no rows) all weights are 0 and every score is 0.5.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    sample = materialize(features(labelled.where(F.col(label_col).isin(0, 1)), text_col, [id_col, label_col]), "bt-features")
    rows = sample.select(id_col, F.col(label_col).cast("int").alias("y"), "features")
    stats = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r.y: r.n for r in stats}
    if len(n) < 2:
        return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, cut_score)
    moments = rows.agg(*[f(F.col("features")[i]) for i in range(N_FEATURES) for f in (F.avg, F.stddev_pop)]).first()
    mean, scale = np.array(moments[0::2]), np.array(moments[1::2])
    scale[scale < 1e-9] = 1.0

    # Preference pairs: the rarer class goes to ``pairs_each`` buckets a row, the other to one;
    # a bucket holds about one row of the other class, so pairs are about pairs_each a rare row.
    few, many = (0, 1) if n[0] <= n[1] else (1, 0)
    buckets = n[many]
    rare = rows.where(F.col("y") == few).select(F.col("features").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(pairs_each)), lambda i: F.pmod(F.xxhash64(F.col(id_col), i), F.lit(buckets)))).alias("bucket"))
    other = rows.where(F.col("y") == many).select(F.col("features").alias("b"), F.col(id_col).alias("id"),
                                                  F.pmod(F.xxhash64(id_col, F.lit("other")), F.lit(buckets)).alias("bucket"))
    scales = F.array(*[F.lit(float(s)) for s in scale])
    better, worse = ("b", "a") if few == 0 else ("a", "b")
    side = F.when(F.pmod(F.xxhash64("id", "bucket"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    pairs = rare.join(other, "bucket").select(side.alias("side"), F.transform(
        F.zip_with(F.zip_with(better, worse, lambda x, y: x - y), scales, lambda d, s: d / s), lambda d: d).alias("gap"))
    pairs = materialize(pairs.select(((F.col("side") + 1) / 2).alias("label"),
                                     F.transform("gap", lambda d: d * F.col("side")).alias("gap")), "bt-pairs")
    seen = {r.label for r in pairs.select("label").distinct().collect()}
    if len(seen) < 2:  # a pair or none: both ways round hold the same preference
        pairs = pairs.unionByName(pairs.select((1 - F.col("label")).alias("label"), F.transform("gap", lambda d: -d).alias("gap")))
        if not seen:
            return Ranking(mean, scale, np.zeros(N_FEATURES), 0.0, cut_score)
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=reg, maxIter=100).fit(
        pairs.select("label", array_to_vector("gap").alias("features")))
    ranking = Ranking(mean, scale, model.coefficients.toArray(), 0.0, cut_score)

    # The cut: the quantile of the training scores that errs least against the labels.
    got = rows.select("y", "features").toPandas()  # at most about max_labelled rows
    raw, y = ranking.raw(np.stack(got["features"])), got["y"].to_numpy()
    order = np.argsort(raw, kind="stable")
    raw, y = raw[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y == 1)]) / n[1] + (n[0] - np.concatenate([[0], np.cumsum(y == 0)])) / n[0]
    level = int(np.argmin(errors))
    low, high = raw[max(level - 1, 0)], raw[min(level, len(raw) - 1)]
    ranking.cut = float((low + high) / 2)
    return ranking


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, text, label) of the labelled rows that may be learnt from, about ``max_labelled`` by a hash of the id."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (id_crc(id_col) % 5 != 0)).select(
        F.col(id_col).alias("label_id"), F.col(label_col).alias("label_value"))
    total = usable.count()
    if total > max_labelled:
        usable = usable.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_003)) < int(1_000_003 * max_labelled / total))
    usable = usable.groupBy("label_id").agg(F.max("label_value").alias("label_value"))  # a row an id
    return docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("label_text")).join(
        F.broadcast(usable), "label_id")


def score_quality(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), held_out, score and predicted of every whole text.

    A null text scores as an empty one.  A null id is not held out.
    """
    kept = [c for c in (keep or docs.columns) if c not in ("held_out", "score", "predicted")]
    ship(docs.sparkSession)
    source = docs.select(*kept, F.col(text_col).alias(fresh(docs.select(*kept), "text_to_score")[0]))
    schema = docs.select(*kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([text_features(t) for t in texts(batch.column(batch.num_columns - 1))]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ranking.score(rows), pa.float64())], names=schema.names)

    cut = CUT_SCORE
    return source.mapInArrow(run, schema).select(
        *kept, F.coalesce(id_crc(id_col) % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))


def quality_model(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranking:
    """The ranking learnt from ``labels.quality`` of rows outside the held-out fold."""
    return fit_ranking(training_rows(docs, labels, max_labelled), "label_value", "label_id", "label_text", max_labelled)


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality scores of all ``documents``, learnt from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = quality_model(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, ranking, keep=["doc_id"])
