"""op1: embedding near-duplicates by an exact metric range join.

Angles between vectors are a metric, so cosine >= t is "within the angle r = arccos(t)".  In
each group (equal label and dimension) pivots cut the space into cells, each vector being at
home with its nearest pivot p.  By the triangle inequality a vector of cell q can only be
within r of x if d(x, q) - d(x, p) <= 2r, so x is copied to those cells and to no other, and
each cell joins its home vectors with its members on its own: every link is seen in the home
cell of either end.  Cells of many vectors are cut into tiles of bounded size, each a
block of home vectors against a block of members, so neither copies nor near copies in great
numbers meet in one task.

Pivots come from a bounded sample by hash (``tile_rows`` decides their number); they only
decide which tiles exist, not the result.  Equal vectors of a label are collapsed first.  A
tile returns counts and the links of a spanning forest, never pairs: links found inside a
tile that join nothing new are only counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, components, fresh, materialize, runs, ship, table

THRESHOLD, TILE_ROWS, MAX_PIVOTS = 0.93, 4096, 64
_SLACK = 1e-6  # of angles and products: more is copied and checked, never less


def usable(vector: Column, label: Column) -> Column:
    """Neither null nor empty nor zero, all components finite, and a label."""
    return (label.isNotNull() & vector.isNotNull() & (F.size(vector) > 0)
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vector, lambda x: x != 0))


def units(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _cells(vectors: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """(cell, home) for every cell a vector is at home in or copied to."""
    schema = vectors.select("*").schema.add("cell", "integer").add("home", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = list(zip(batch["label"].to_pylist(), batch["dim"].to_pylist()))
            by: dict = {}
            for i, g in enumerate(groups):
                by.setdefault(g, []).append(i)
            take, cell, home = [], [], []
            for g, rows in by.items():
                if g not in pivots:
                    take += rows
                    cell += [0] * len(rows)
                    home += [True] * len(rows)
                    continue
                away = np.arccos(np.clip(units(batch["vector"].take(pa.array(rows))) @ pivots[g].T, -1, 1))
                near = away.argmin(axis=1)
                at, to = np.nonzero(away - away.min(axis=1, keepdims=True) <= 2 * radius + _SLACK)
                take += [rows[i] for i in at]
                cell += to.tolist()
                home += (near[at] == to).tolist()
            out = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell, pa.int32()), pa.array(home, pa.bool_())], names=schema.names)

    return vectors.mapInArrow(run, schema)


def join_tile(home: np.ndarray, member: np.ndarray, same: np.ndarray, copies: np.ndarray,
              threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links counted per home row, smallest connected row of home + member per row).

    ``same[i]`` is the member row equal to home row i, or -1; ``copies`` counts equal vectors
    behind a member row.  A home vector's own copies count as links, itself does not.
    """
    n, m = len(home), len(member)
    counts = np.zeros(n, np.int64)
    linked = np.zeros((n, m), bool)
    for a in range(0, n, 512):
        cosine = home[a:a + 512] @ member.T
        close = cosine >= threshold
        for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-12)):  # at the edge, sum exactly
            close[i, j] = math.fsum(home[a + i] * member[j]) >= threshold
        linked[a:a + 512] = close
    rows = np.flatnonzero(same >= 0)
    linked[rows, same[rows]] = True
    counts = linked @ copies
    counts[rows] -= 1
    root = np.arange(n + m)
    root[rows] = n + same[rows]
    live = np.flatnonzero(linked.sum(axis=1) > (same >= 0))
    if len(live):
        part = linked[live]
        cols = np.flatnonzero(part.any(axis=0))
        part = part[:, cols]
        low = cols + n
        while True:  # labels flow between the two sides until nothing changes
            row_low = np.where(part, low[None, :], n + m).min(axis=1)
            new = np.minimum(low, np.where(part, row_low[:, None], n + m).min(axis=0))
            if (new == low).all():
                break
            low = new
        root[cols + n] = low
        root[live] = row_low
    return counts, root


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``df`` with n_links, component_id and kept.

    A vector that is null, empty, zero or not finite in some component, or has a null label,
    has no links and is a component of its own, as are vectors of different lengths.  Copies
    link with each other.  ``component_id`` is the smallest id of the component; null ids
    have links and are kept out of the minimum.  ``kept`` is id = component_id (false for a
    null id).  Other columns stay, but for those of the three names.
    """
    spark = df.sparkSession
    ship(spark)
    source = df.drop("n_links", "component_id", "kept")
    key_col, = fresh(source, "vector_key")
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 as 0.0
    label = F.col(label_col)
    key = F.when(usable(vector, label), F.md5(F.concat_ws("|", label.cast("string"), F.array_join(vector, ",")).cast("binary")))
    rows = source.withColumn(key_col, key)
    distinct = materialize(
        rows.where(F.col(key_col).isNotNull())
        .select(F.col(key_col).alias("key"), F.col(id_col).alias("id"), label.alias("label"), F.size(vector_col).alias("dim"), vector.alias("vector"))
        .groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
                            F.first("dim").alias("dim"), F.first("vector").alias("vector")), "emb-distinct")

    # Pivots: for groups of over tile_rows vectors, about one for each tile, by a hash.
    sizes = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile_rows)
    big = broadcast_below(materialize(sizes, "emb-sizes"))
    share = F.least(F.ceil(F.col("n") / tile_rows), F.lit(max_pivots)) / F.col("n")
    drawn = distinct.join(big, ["label", "dim"]).where(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32) < share).select("label", "dim", "vector").collect()
    pivots: dict = {}
    for r in sorted(drawn, key=lambda r: r.vector):  # at most about max_pivots a group
        pivots.setdefault((r.label, r.dim), []).append(r.vector)
    pivots = {g: units(pa.array(v, pa.list_(pa.float64()))) for g, v in pivots.items()}

    placed = materialize(_cells(distinct.select("key", "copies", "label", "dim", "vector"), pivots, math.acos(threshold)), "emb-cells")
    blocks = placed.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / tile_rows).alias("home_blocks"), F.ceil(F.count(F.lit(1)) / tile_rows).alias("member_blocks"))
    placed = placed.join(broadcast_below(materialize(blocks, "emb-blocks")), ["label", "dim", "cell"])
    block = lambda n: F.pmod(F.xxhash64("key"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    as_home = placed.where("home").select("label", "dim", "cell", block("home_blocks").alias("i"), every("member_blocks").alias("j"),
                                          F.lit(0).alias("side"), "key", "copies", "vector")
    as_member = placed.where("home_blocks > 0").select("label", "dim", "cell", every("home_blocks").alias("i"), block("member_blocks").alias("j"),
                                                       F.lit(1).alias("side"), "key", "copies", "vector")
    tile = ["label", "dim", "cell", "i", "j"]
    tiles = as_home.unionByName(as_member).repartition(*tile).sortWithinPartitions(*tile, "side", "key")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, tile):
            side = group["side"].to_numpy()
            keys = group["key"].to_pylist()
            n = int((side == 0).sum())
            vectors = units(group["vector"])
            where = {k: j for j, k in enumerate(keys[n:])}
            same = np.array([where.get(k, -1) for k in keys[:n]], np.int64)
            counts, root = join_tile(vectors[:n], vectors[n:], same, group["copies"].to_numpy()[n:], threshold)
            names = np.array(keys, object)
            moved = np.flatnonzero(root != np.arange(len(keys)))
            moved = moved[names[moved] != names[root[moved]]]
            live = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([keys[i] for i in live] + names[moved].tolist(), pa.string()),
                "links": pa.array(counts[live].tolist() + [0] * len(moved), pa.int64()),
                "near": pa.array([None] * len(live) + names[root[moved]].tolist(), pa.string())})

    found = materialize(tiles.mapInArrow(join, "key string, links long, near string"), "emb-links")
    roots = components(found.where("near is not null"), "key", "near", "emb")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    nodes = distinct.select("key", "id").join(links, "key", "left").join(
        roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = nodes.groupBy("root").agg(F.min("id").alias("component_id"))
    per_key = nodes.join(smallest, "root").select(F.col("key").alias(key_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id")
    out = rows.join(per_key, key_col, "left")
    component = F.when(F.col(key_col).isNull(), F.col(id_col).cast("long")).otherwise(F.col("component_id").cast("long"))
    return out.select(*source.columns, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col(id_col) == component, F.lit(False)).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links, components and survivors of all ``embeddings`` at cosine 0.93 within a label."""
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).drop("embedding", "label")


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""
