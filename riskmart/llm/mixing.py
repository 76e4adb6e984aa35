"""op5: mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words; the ratio of target to size gives each of its
documents certain whole copies (the integer part) and leaves a remainder of words.  The
remainder is filled by an unequal-probability sample: a document's inclusion probability
grows with the root of its size, its random number is a hash, and documents rank by

    odds(random) / odds(inclusion),

the Pareto order.  The sample goes down that order and takes every document that still fits.
It does so in runs: a run is the longest piece of the order whose words fit into what is left; the
next one starts after the document that did not fit and passes over all that are larger than what
is left by then.  Runs end when no document fits or a source is within ``TOLERANCE`` of its
target; a large source needs one run.  After each run there is one closing document, the one whose
size is nearest to what is missing then (none if that would not bring the words nearer), and
the sample is that of as many runs, with their closing document, as come nearest to the target.

Only DataFrame functions are used.  A source may hold most of the rows: its order is cut into
buckets of the rank variable, words are summed by bucket, and only documents of the one
bucket where a run ends are ordered row by row.  Their number is that of one bucket,
as buckets grow in number with the rows.  A round is one query over the documents that still
fit, written anew for each round, and leaves one row a source: where its run begins and ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import fresh, materialize, table, word_count

WEIGHTS, SHARE, MOST_COPIES, SEED = (3, 1, 2), 1.5, 2, "mix"
#: A source is full when the words that it misses are at most so large a share of its target.
TOLERANCE = 0.0005
#: About so many documents of a source share a bucket of its rank variable.
BUCKET_ROWS = 20_000


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5; the same in any engine."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, source_col: str, size_col: str, weights: Sequence[int],
                   share: float, most: int) -> DataFrame:
    """(source, source_size, n_docs, target): words each source gives to the mix.

    ``weights`` go round the sources by code point, null last.  Targets split ``share`` times
    all sizes by weight; a target above ``most`` times its source's size is set to that, and
    the excess goes to the others by weight until none is above.  In closed form: sources
    reach their limit in the order of limit / weight, so the level of the rest follows from
    running sums in that order.  The table has one row a source.
    """
    per = sizes.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size_col).alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = per.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "at")
    so_far = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (ranked
              .withColumn("capped", F.coalesce(F.sum("most").over(so_far), F.lit(0)))
              .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(so_far), F.lit(0)))
              # the level if the sources before this one are at their limits and no other is
              .withColumn("level", (F.sum("source_size").over(everything) * share - F.col("capped")) / F.col("open_weight")))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "at", "level"))
    level = F.coalesce(F.min(fits).over(everything)["level"], F.lit(float("inf")))
    return levels.select("source", "source_size", "n_docs",
                         F.least(F.col("most").cast("double"), level * F.col("weight")).alias("target"))


def _run_ends(rest: DataFrame) -> DataFrame:
    """(source, to_bucket, to_place, left): where the longest run that fits into ``words`` ends, and the words it leaves.

    ``rest`` has (source, bucket, place, size, words).  A run stops before ``to_place``, the first
    document that does not fit; with both null it holds all documents.
    """
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rest.groupBy("source", "bucket").agg(F.sum("size").alias("held"), F.max("words").alias("words"))
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    whole = sums.groupBy("source").agg((F.max("words") - F.sum("held")).alias("over"))
    # the bucket in which the words end, and in it the first document that they do not reach
    ends = sums.where("before <= words and before + held > words").select(
        F.col("source").alias("e_source"), F.col("bucket").alias("e_bucket"), "before", F.col("words").alias("e_words"))
    edge = rest.join(ends, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket")))
    so_far = F.col("before") + F.sum("size").over(Window.partitionBy("e_source").orderBy("place"))  # equal places together
    edge = edge.select("e_source", "e_bucket", "place", "before", "e_words", so_far.alias("so_far"))
    fits = F.col("so_far") <= F.col("e_words")
    stop = edge.groupBy("e_source", "e_bucket").agg(
        F.min(F.when(~fits, F.col("place"))).alias("to_place"),
        (F.max("e_words") - F.coalesce(F.max(F.when(fits, F.col("so_far"))), F.max("before"))).alias("gap"))
    return whole.join(stop, F.col("source").eqNullSafe(F.col("e_source")), "left").select(
        "source", F.col("e_bucket").alias("to_bucket"), "to_place", F.coalesce("gap", "over").alias("left"))


def _beyond(bucket: Column, place: Column) -> Column:
    """Whether a document comes after ``place`` in the order; every one does after a null."""
    return bucket.isNull() | (F.col("bucket") > bucket) | ((F.col("bucket") == bucket) & (F.col("place") > place))


def _short_of(bucket: Column, place: Column) -> Column:
    """Whether a document comes before ``place`` in the order; every one does before a null."""
    return bucket.isNull() | (F.col("bucket") < bucket) | ((F.col("bucket") == bucket) & (F.col("place") < place))


def sample_runs(live: DataFrame, tolerance: float) -> DataFrame:
    """(source, run, left, runs): for each number of runs the runs and the words that they leave.

    ``live`` has (source, bucket, place, size, words, target).  A run is (from_bucket, from_place,
    most, to_bucket, to_place): the documents after from and before to of at most ``most`` words.
    """
    rest, done = live, None
    nothing = live.select(F.col("bucket").alias("from_bucket"), F.col("place").alias("from_place")).schema
    start = live.groupBy("source").agg(F.max("words").alias("most"), F.max("target").alias("target")).select(
        "source", "target", "most", *[F.lit(None).cast(f.dataType).alias(f.name) for f in nothing])
    number = 0
    while True:
        ends = _run_ends(rest).withColumnRenamed("source", "ended")
        run = materialize(start.join(ends, F.col("source").eqNullSafe(F.col("ended"))).drop("ended").withColumn("run", F.lit(number)), "mix-run")
        done = run if done is None else materialize(done.unionByName(run), "mix-runs")
        start = run.where((F.col("to_bucket").isNotNull()) & (F.col("left") > tolerance * F.col("target"))).select(
            "source", "target", F.col("left").alias("most"), F.col("to_bucket").alias("from_bucket"), F.col("to_place").alias("from_place"))
        at = start.select(F.col("source").alias("s_source"), F.col("most").alias("s_most"), "from_bucket", "from_place")
        rest = rest.join(at, F.col("source").eqNullSafe(F.col("s_source"))).where(
            (F.col("size") <= F.col("s_most")) & _beyond(F.col("from_bucket"), F.col("from_place"))).withColumn("words", F.col("s_most"))
        rest = materialize(rest.select(*live.columns), "mix-rest")
        if rest.isEmpty():
            break
        number += 1
    entry = F.struct("run", "left", "from_bucket", "from_place", "most", "to_bucket", "to_place")
    every = done.groupBy("source").agg(F.sort_array(F.collect_list(entry)).alias("every"))
    each = every.select("source", "every", F.explode("every").alias("last"))
    return each.select("source", F.col("last.run").alias("run"), F.col("last.left").alias("left"),
                       F.filter("every", lambda r: r["run"] <= F.col("last.run")).alias("runs"))


def in_runs() -> Column:
    """Whether a document (bucket, place, size) is in one of ``runs``."""
    def within(run: Column) -> Column:
        return (F.col("size") <= run["most"]) & _beyond(run["from_bucket"], run["from_place"]) & _short_of(run["to_bucket"], run["to_place"])
    return F.coalesce(F.exists("runs", within), F.lit(False))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
                seed: str = SEED, keep: Sequence[str] | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``df`` with size, source_size, target, copies and taken.

    ``taken`` is ``copies`` times the document's words.  A null text has size 0, as has an
    empty one, and takes nothing; a null source is a source of its own.  Rows of equal id and size
    have one place in the order (with null ids: of equal text) and come or stay away together.
    ``keep`` lists the columns that stay (all by default).  Columns that ``df`` has under
    the five names give way.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in (keep if keep is not None else df.columns) if c not in new]
    fact, = fresh(df.select(*kept), "mix_fact")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                      F.when(F.col(id_col).isNull(), F.md5(F.col(text_col).cast("binary"))).otherwise(""))
    facts = F.struct(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), uniform(key, seed).alias("u"))
    if text_col in kept:  # wide rows are read again at the end
        base = df.select(F.struct(*kept).alias(fact), facts.alias("f")).select(fact, "f.*")
        narrow = materialize(df.select(facts.alias("f")).select("f.*"), "mix-sizes")
    else:
        base = materialize(df.select(F.struct(*kept).alias(fact), facts.alias("f")).select(fact, "f.*"), "mix-sizes")
        narrow = base.select("source", "size", "u")
    per = materialize(source_targets(narrow, "source", "size", weights, share, most).withColumn(
        "ratio", F.col("target") / F.greatest(F.col("source_size"), F.lit(1))), "mix-targets")
    whole = F.floor("ratio")
    per = per.select(F.col("source").alias("t_source"), "source_size", "target", whole.alias("whole"), (F.col("ratio") - whole).alias("part"),
                     (F.col("target") - whole * F.col("source_size")).alias("words"), (F.col("source_size") / F.col("n_docs")).alias("mean"),
                     (F.ceil(F.col("n_docs") / BUCKET_ROWS) * 16).alias("buckets"))

    def ranked(rows: DataFrame) -> DataFrame:
        """``rows`` with their source's figures, place and bucket."""
        joined = rows.join(per, F.col("source").eqNullSafe(F.col("t_source")))
        inclusion = F.least(F.lit(0.98), F.greatest(F.lit(0.02), F.col("part") * F.sqrt(F.coalesce(F.try_divide(F.col("size"), F.col("mean")), F.lit(1.0)))))
        pareto = (F.col("u") / (1 - F.col("u"))) * ((1 - inclusion) / inclusion)
        return joined.withColumn("q", pareto).withColumn("place", F.struct("q", "u", "size")).withColumn(
            "bucket", F.least(F.col("buckets") - 1, F.floor(F.col("q") / (1 + F.col("q")) * F.col("buckets"))))

    live = materialize(ranked(narrow).where("size > 0 and words > 0").select("source", "bucket", "place", "size", "words", "target"), "mix-live")
    runs = materialize(sample_runs(live, tolerance).withColumnRenamed("source", "r_source"), "mix-sampled")
    missed = F.abs(F.col("left") - F.col("size"))
    closing = live.join(runs, F.col("source").eqNullSafe(F.col("r_source"))).where((missed < F.col("left")) & ~in_runs()).groupBy(
        F.col("source").alias("c_source"), F.col("run").alias("c_run")).agg(F.min(F.struct(missed.alias("missed"), "place")).alias("closing"))
    closed = runs.join(closing, F.col("r_source").eqNullSafe(F.col("c_source")) & (F.col("run") == F.col("c_run")), "left")
    choice = F.struct(F.coalesce("closing.missed", "left").alias("missed"), "run", "runs", F.col("closing.place").alias("closing"))
    runs = materialize(closed.groupBy("r_source").agg(F.min_by(choice, F.struct(choice["missed"], choice["run"])).alias("best")).select("r_source", "best.runs", "best.closing"), "mix-closed")

    out = ranked(base).join(runs, F.col("source").eqNullSafe(F.col("r_source")), "left")
    sampled = in_runs() | F.coalesce(F.col("place") == F.col("closing"), F.lit(False))
    copies = F.when((F.col("size") > 0) & (F.col("words") > 0), F.col("whole") + sampled.cast("long")).when(
        F.col("size") > 0, F.col("whole")).otherwise(F.lit(0)).cast("long")
    return out.select(f"{fact}.*", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Words that a mix of all ``documents`` takes from each, by source targets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || CASE WHEN doc_id IS NULL THEN coalesce(md5(text), '') ELSE '' END), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source),
ranked AS (
  SELECT *, [3, 1, 2][((pos - 1) % 3)::INT + 1] AS weight, source_size * 2 AS most
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS pos FROM per)),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(most) OVER w, 0)::DOUBLE)
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM ranked
  WINDOW w AS (ORDER BY most::DOUBLE / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
reached AS (SELECT arg_min(level, (most::DOUBLE / weight, pos)) AS top FROM levels WHERE level * weight <= most),
targets AS (
  SELECT source, source_size, n_docs, least(most::DOUBLE, coalesce(top, 'Infinity'::DOUBLE) * weight) AS target
  FROM levels, reached),
r AS (
  SELECT d.doc_id, d.source, d.size, d.u, t.source_size, t.target,
         floor(t.target / greatest(t.source_size, 1)) AS whole,
         t.target / greatest(t.source_size, 1) - floor(t.target / greatest(t.source_size, 1)) AS part,
         t.target - floor(t.target / greatest(t.source_size, 1)) * t.source_size AS rest,
         t.source_size::DOUBLE / t.n_docs AS mean
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
i AS (SELECT *, least(0.98, greatest(0.02, part * sqrt(size / mean))) AS inclusion FROM r),
q AS (SELECT *, (u / (1 - u)) * ((1 - inclusion) / inclusion) AS q FROM i),
c AS MATERIALIZED (SELECT *, {'q': q, 'u': u, 'size': size} AS place, size > 0 AND rest > 0 AS live FROM q),
run AS (
  SELECT source, -1 AS n, NULL::STRUCT(q DOUBLE, u DOUBLE, size BIGINT) AS start, max(rest) AS most,
         NULL::STRUCT(q DOUBLE, u DOUBLE, size BIGINT) AS stop, max(rest) AS gap, max(target) AS target
  FROM c WHERE live GROUP BY source
  UNION ALL
  SELECT any_value(source), any_value(n) + 1, any_value(stop), any_value(gap), min(place) FILTER (WHERE words > gap),
         any_value(gap) - coalesce(max(words) FILTER (WHERE words <= gap), 0), any_value(target)
  FROM (SELECT r.*, c.place, sum(c.size) OVER (PARTITION BY r.source ORDER BY c.place) AS words
        FROM run r JOIN c ON c.source IS NOT DISTINCT FROM r.source AND c.live AND c.size <= r.gap AND (r.n = -1 OR c.place > r.stop)
        WHERE r.n = -1 OR (r.stop IS NOT NULL AND r.gap > 0.0005 * r.target))
  GROUP BY coalesce(source, ''), source IS NULL),
placed AS (
  SELECT c.*, r.n AS in_run FROM c LEFT JOIN run r
    ON r.n >= 0 AND c.live AND c.source IS NOT DISTINCT FROM r.source AND c.size <= r.most
       AND (r.start IS NULL OR c.place > r.start) AND (r.stop IS NULL OR c.place < r.stop)),
closing AS (
  SELECT r.source, r.n, min({'missed': abs(r.gap - p.size), 'place': p.place}) AS closing
  FROM run r JOIN placed p ON p.source IS NOT DISTINCT FROM r.source AND p.live AND r.n >= 0 AND (p.in_run IS NULL OR p.in_run > r.n) AND abs(r.gap - p.size) < r.gap
  GROUP BY r.source, r.n),
best AS (
  SELECT r.source, min({'missed': coalesce(d.closing.missed, r.gap), 'n': r.n, 'closing': d.closing.place}) AS best
  FROM run r LEFT JOIN closing d ON d.source IS NOT DISTINCT FROM r.source AND d.n = r.n WHERE r.n >= 0 GROUP BY r.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size > 0 THEN whole + CASE WHEN p.live AND (coalesce(p.in_run <= b.best.n, FALSE) OR coalesce(p.place = b.best.closing, FALSE)) THEN 1 ELSE 0 END
             ELSE 0 END)::BIGINT * size AS taken
FROM placed p LEFT JOIN best b ON p.source IS NOT DISTINCT FROM b.source
"""
