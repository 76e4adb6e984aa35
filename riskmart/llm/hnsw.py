"""op12: approximate nearest neighbours by a navigable small-world graph per shard.

Rows are dealt to shards by a hash of id and vector, so copies of one vector spread evenly.
About sqrt(n / 1024) shards share n rows, more where a shard would hold over 65,536.  A shard is
built in one task and stored as one row: vectors, ids, and for every layer a flat array of
neighbour numbers.  Within a shard equal vectors are one node.

A shard's nodes are in random order and the first n / 16^l of them make layer l, so a layer is a
prefix and needs no map of its own.  Nodes are inserted in batches: the batch searches the graph
that is there (and its own members by a product of matrices), picks diverse neighbours (a
candidate closer to a chosen neighbour than to the node is taken only if places stay
empty), and is linked back; lists that overflow are picked anew.  Searches of a batch run in
step: each expands its best open nodes, and scores of all new neighbours are one product.
Nodes that no path from the entry reaches are listed, and every search scores them all.

Queries go round in blocks of bounded bytes.  Every shard answers every query with its k
nearest, scored on the original vectors in double precision; the answers merge by score and id.
The beam of a search grows with the root of the shard's nodes, which keeps recall level.  The graph
decides which rows are compared, so results are approximate; a shard of up to 512 nodes is
compared as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, materialize, new_path, runs, ship, table
from riskmart.llm.embedding_dedup import units
from riskmart.llm.whitening import finite

LINKS, EF_BUILD, EF_SEARCH, WIDTH = 16, 64, 128, 4
SHARD_SCALE, SHARD_ROWS, WHOLE, BATCH = 1024, 65_536, 512, 512
EF_NODES = 8192  # EF_SEARCH holds for shards of so many nodes
QUERY_BYTES = 8 << 20


# ------------------------------------------------------------------ the graph of a shard
def layer_sizes(n: int) -> list[int]:
    sizes = [n]
    while sizes[-1] >= 4 * LINKS * LINKS:
        sizes.append(sizes[-1] // LINKS)
    return sizes


def beam(u: np.ndarray, q: np.ndarray, links: np.ndarray, start: np.ndarray, ef: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the best ``ef`` that each query finds from its start nodes, best first; -1 where none."""
    n_q, cap = len(q), links.shape[1]
    ids, scores = np.full((n_q, ef), -1, np.int64), np.full((n_q, ef), -np.inf, np.float32)
    seen = np.zeros((n_q, nodes), np.int16)  # 1 + the place at which a node was met first
    first = np.einsum("qd,qsd->qs", q, u[start])
    order = np.argsort(-first, axis=1)[:, :ef]
    ids[:, :order.shape[1]], scores[:, :order.shape[1]] = np.take_along_axis(start, order, 1), np.take_along_axis(first, order, 1)
    np.put_along_axis(seen, start, 1, axis=1)
    closed = ids < 0
    live = np.arange(n_q)
    places = np.arange(1, WIDTH * cap + 1, dtype=np.int16)[None, :]
    while True:
        live = live[~closed[live].all(axis=1)]
        if not len(live):
            return ids, scores
        at = np.argsort(closed[live], axis=1, kind="stable")[:, :WIDTH]  # rows are in order of score
        open_ = ~np.take_along_axis(closed[live], at, 1)
        taken = np.take_along_axis(ids[live], at, 1)
        shut = closed[live]
        np.put_along_axis(shut, at, True, axis=1)
        near = np.where(open_[:, :, None], links[taken], -1).reshape(len(live), -1)
        rows = np.broadcast_to(live[:, None], near.shape)
        fresh = (near >= 0) & (seen[rows, near] == 0)
        place = np.broadcast_to(places[:, :near.shape[1]], near.shape)
        seen[rows[fresh], near[fresh]] = place[fresh]
        fresh &= seen[rows, near] == place  # once, if two open nodes share a neighbour
        r, c = np.nonzero(fresh)
        found = near[r, c]
        new = np.full(near.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("ij,ij->i", q[live[r]], u[found])
        every = np.concatenate([scores[live], new], axis=1)
        best = np.argpartition(-every, ef - 1, axis=1)[:, :ef]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(every, best, 1), axis=1), 1)
        scores[live] = np.take_along_axis(every, best, 1)
        held = np.take_along_axis(np.concatenate([ids[live], near], axis=1), best, 1)
        held[~np.isfinite(scores[live])] = -1
        ids[live] = held
        closed[live] = np.take_along_axis(np.concatenate([shut, np.zeros(near.shape, bool)], axis=1), best, 1) | (held < 0)


def pick(u: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` neighbours of each row from its candidates in order of score: diverse ones, then the next best."""
    vectors = u[np.maximum(ids, 0)]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    kept, number = np.zeros(ids.shape, bool), np.zeros(len(ids), int)
    for j in range(ids.shape[1]):
        ok = (ids[:, j] >= 0) & (number < most) & ~((between[:, j, :j] > scores[:, j, None]) & kept[:, :j]).any(axis=1)
        kept[:, j] = ok
        number += ok
    order = np.argsort(~kept, axis=1, kind="stable")[:, :most]
    out = np.full((len(ids), most), -1, np.int64)
    out[:, :order.shape[1]] = np.take_along_axis(ids, order, 1)
    return out


def _by_score(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-scores, axis=1, kind="stable")[:, :most]
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    return np.where(np.isfinite(scores), ids, -1), scores


def link_back(u: np.ndarray, links: np.ndarray, degree: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Links to ``new`` from the neighbours they chose; a list that overflows is picked anew."""
    r, c = np.nonzero(chosen >= 0)
    source, target = new[r], chosen[r, c]
    scores = np.einsum("ij,ij->i", u[source], u[target])
    order = np.lexsort((-scores, target))
    source, target, scores = source[order], target[order], scores[order]
    heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, int)
    counts = np.diff(np.r_[heads, len(target)])
    within = np.arange(len(target)) - np.repeat(heads, counts)
    cap = links.shape[1]
    room = np.repeat(degree[target[heads]] + counts <= cap, counts)
    links[target[room], degree[target[room]] + within[room]] = source[room]
    whole = degree[target[heads]] + counts <= cap
    degree[target[heads][whole]] += counts[whole]
    full = np.flatnonzero(~whole)
    for at in range(0, len(full), BATCH):
        some = full[at:at + BATCH]
        nodes = target[heads[some]]
        into = np.full((len(some), cap), -1, np.int64)  # the best new links of each list
        mine = np.flatnonzero(np.isin(target, nodes) & (within < cap))
        into[np.searchsorted(nodes, target[mine]), within[mine]] = source[mine]
        ids = np.concatenate([links[nodes], into], axis=1)
        near = np.where(ids >= 0, np.einsum("nd,ncd->nc", u[nodes], u[np.maximum(ids, 0)]), -np.inf)
        ids, near = _by_score(ids, near, ids.shape[1])
        best = pick(u, ids, near, cap - cap // 4)
        links[nodes] = -1
        links[nodes, :best.shape[1]] = best
        degree[nodes] = (best >= 0).sum(axis=1)


def descend(u: np.ndarray, q: np.ndarray, layers: list[np.ndarray], lowest: int, present: int) -> np.ndarray:
    """Start nodes of each query for layer ``lowest`` of a graph of the first ``present`` nodes."""
    start = np.zeros((len(q), 1), np.int64)
    for links in layers[:lowest:-1]:
        nodes = min(present, len(links))
        found, _ = beam(u, q, links, start, min(8, nodes), nodes)
        start = np.where(found[:, :4] >= 0, found[:, :4], found[:, :1])
    return start


def build(u: np.ndarray) -> list[np.ndarray]:
    """Neighbour arrays of every layer of the graph over unit vectors in random order."""
    sizes = layer_sizes(len(u))
    layers = [np.full((n, 2 * LINKS), -1, np.int64) for n in sizes]
    degrees = [np.zeros(n, np.int64) for n in sizes]
    at = 0
    while at < len(u):
        end = min(len(u), at + min(max(at, BATCH // 2), BATCH))
        for level, (links, degree) in enumerate(zip(layers, degrees)):
            new = np.arange(at, min(end, len(links)))
            if not len(new):
                break
            q = u[new]
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            most = min(EF_BUILD, len(new))
            near = np.argpartition(-own, most - 1, axis=1)[:, :most]
            ids, scores = new[near], np.take_along_axis(own, near, 1)
            if at:
                there = min(at, len(links))
                found, there_scores = beam(u, q, links, descend(u, q, layers, level, at), min(EF_BUILD, there), there)
                ids, scores = np.concatenate([found, ids], axis=1), np.concatenate([there_scores, scores], axis=1)
            ids, scores = _by_score(ids, scores, EF_BUILD)
            chosen = pick(u, ids, scores, LINKS)
            links[new, :LINKS] = chosen
            degree[new] = (chosen >= 0).sum(axis=1)
            link_back(u, links, degree, new, np.where((links[np.maximum(chosen, 0)] == new[:, None, None]).any(axis=2), -1, chosen))
        at = end
    return layers


def unreached(layers: list[np.ndarray]) -> np.ndarray:
    """Nodes that no path from the entry reaches."""
    met = np.zeros(len(layers[0]), bool)
    front = np.array([0])
    while len(front):
        met[front] = True
        near = np.unique(np.concatenate([links[front[front < len(links)]].ravel() for links in layers]))
        front = near[(near >= 0) & ~met[near]]
    return np.flatnonzero(~met)


def search(u: np.ndarray, layers: list[np.ndarray], loose: np.ndarray, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the best that the graph finds for unit queries, with every unreached node."""
    if len(u) <= WHOLE:
        scores = q @ u.T
        return _by_score(np.broadcast_to(np.arange(len(u)), scores.shape), scores, ef)
    ids, scores = beam(u, q, layers[0], descend(u, q, layers, 0, len(u)), min(ef, len(u)), len(u))
    for at in range(0, len(loose), 4096):
        more = loose[at:at + 4096]
        ids, scores = _by_score(np.concatenate([ids, np.broadcast_to(more, (len(q), len(more)))], axis=1),
                                np.concatenate([scores, q @ u[more].T], axis=1), ef)
    return ids, scores


# ------------------------------------------------------------------ shards as rows
def usable(vector):
    """Neither null nor empty nor zero, all components finite."""
    return finite(vector) & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0)


def _prepared(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector) of the usable rows, each once; only repeated ids are compared."""
    kind = "float" if df.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    rows = rows.select("id", F.size("vector").alias("dim"), F.transform("vector", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("vector"))
    again = materialize(rows.groupBy(F.col("id").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("again"), "ann-again")
    if again.isEmpty():
        return rows
    same = F.col("id").eqNullSafe(F.col("again"))
    again = broadcast_below(again)
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").distinct())


def _flat(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.ravel(), kind))


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                shard_scale: int = SHARD_SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: (dim, ids, owners, vectors, layers, links, loose).

    ``ids`` are all rows of the shard in order of (owner, id), ``owners`` the node of each;
    ``vectors`` holds a vector a node; ``layers`` are the layers' sizes and ``links`` their flat
    neighbour arrays, one after the other, -1 where a list ends; ``loose`` are unreached nodes.
    """
    spark = df.sparkSession
    ship(spark)
    rows = _prepared(df, id_col, vector_col)
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).withColumn("shards", F.greatest(
        F.ceil(F.sqrt(F.col("n") / shard_scale)), F.ceil(F.col("n") / shard_rows)))
    sizes = materialize(sizes.withColumn("first", F.sum("shards").over(Window.orderBy("dim")) - F.col("shards")).drop("n"), "ann-shards")
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = rows.join(broadcast_below(sizes), "dim").select(
        "id", "dim", "vector", F.xxhash64("vector").alias("order"),
        (F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("shards"))).cast("int").alias("shard"))
    dealt = dealt.repartitionById(int(total), "shard").sortWithinPartitions("shard", "order", F.col("id").asc_nulls_last())
    element = rows.schema["vector"].dataType.elementType.simpleString()
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"dim int, ids array<{id_type}>, owners array<int>, vectors array<{element}>, layers array<int>, links array<int>, loose array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in runs(batches, ["shard"]):
            dim, flat = shard["dim"][0].as_py(), shard["vector"].combine_chunks()
            x = np.ascontiguousarray(flat.flatten().to_numpy(zero_copy_only=False).reshape(len(shard), -1))
            _, first, owner = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * dim)))[:, 0], return_index=True, return_inverse=True)
            rank = np.empty(len(first), np.int64)
            rank[np.argsort(first)] = np.arange(len(first))
            owner, x = rank[owner], x[np.sort(first)]
            order = np.argsort(owner, kind="stable")  # ids of a node stay in order
            layers = build(units(pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(shard)], pa.int32()), shard["id"].combine_chunks().take(pa.array(order))),
                _flat(owner[order], pa.int32()), _flat(x, flat.type.value_type), pa.array([[len(a) for a in layers]], pa.list_(pa.int32())),
                _flat(np.concatenate([a.ravel() for a in layers]), pa.int32()), _flat(unreached(layers), pa.int32())],
                names=["dim", "ids", "owners", "vectors", "layers", "links", "loose"])

    return materialize(dealt.mapInArrow(run, schema), "ann-index")


def _answers(shard: dict, q: np.ndarray, query_ids: list, k: int, ef: int) -> tuple[list, list, list]:
    """(query numbers, ids, scores): the k nearest rows of a shard for each unit query, other ids than its own."""
    x = shard["vectors"].to_numpy(zero_copy_only=False).reshape(-1, q.shape[1])
    exact = units(pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]))
    u, q32 = exact.astype(np.float32), q.astype(np.float32)
    links, layers, at = shard["links"].to_numpy(), [], 0
    for n in shard["layers"].to_pylist():
        layers.append(links[at:at + n * 2 * LINKS].reshape(n, -1).astype(np.int64))
        at += n * 2 * LINKS
    ids, owners, loose = shard["ids"].to_pylist(), shard["owners"].to_numpy(), shard["loose"].to_numpy().astype(np.int64)
    head = np.r_[np.searchsorted(owners, np.arange(len(u))), len(owners)]
    step = max(1, min(256, (64 << 20) // (2 * len(u))))
    beam_size = max(ef, math.ceil(ef * math.sqrt(len(u) / EF_NODES)), 4 * k + 4)
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(q), step):
        nodes, _ = search(u, layers, loose, q32[at:at + step], beam_size)
        for i, found in enumerate(nodes, at):
            found = found[found >= 0][:4 * k + 4]
            scores = exact[found] @ q[i]
            near, own = [], query_ids[i]
            for node, score in zip(found.tolist(), scores.tolist()):
                some = [v for v in ids[head[node]:min(head[node + 1], head[node] + k + 1)] if own is None or v != own]
                near += [(-score, v is None, v) for v in some]
            near.sort(key=lambda n: n[:2] + (() if n[1] else (n[2],)))
            for score, _, v in near[:k]:
                out[0].append(i)
                out[1].append(v)
                out[2].append(-score)
    return out


def search_index(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 k: int = 5, ef: int = EF_SEARCH, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, <id_col>, score): the k nearest rows found for each query.

    A row with the query's own id is no candidate; a query with a null id has none of its own.
    Null ids are candidates and come last among ties.  Equal queries (id and vector) count once;
    an id with several vectors is several queries, ranked each for itself.  ``ef`` is the beam of a
    shard of ``EF_NODES`` nodes or fewer.  Queries that are null,
    empty, zero or not finite find nothing, nor do those of a length that the index lacks.
    """
    spark = index.sparkSession
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    asked = _prepared(queries, id_col, vector_col)
    asked = materialize(asked.select("id", "dim", F.transform("vector", lambda x: x.cast("double")).alias("vector")), "ann-queries")
    size = asked.agg(F.sum(F.col("dim").cast("long") * 8 + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / query_bytes))
    at, found = new_path(spark, "ann-blocks"), new_path(spark, "ann-found")
    asked.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")).repartition("block").write.partitionBy("block").parquet(at)
    schema = f"q int, query_id {asked.schema['id'].dataType.simpleString()}, id {id_type}, score double"
    present = [r.block for r in spark.read.schema(f"{asked._jdf.schema().toDDL()}, block int").parquet(at).select("block").distinct().collect()] if size else []
    for block in sorted(present):
        held = spark.read.schema(asked.schema).parquet(f"{at}/block={block}").toArrow()  # query_bytes and some
        dims = held["dim"].to_numpy()
        sent = spark.sparkContext.broadcast((held["id"].to_pylist(), {
            int(d): (np.flatnonzero(dims == d), units(held["vector"].filter(pa.array(dims == d)))) for d in np.unique(dims)}))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            all_ids, by_dim = sent.value
            for batch in batches:
                for i in range(batch.num_rows):
                    dim = batch["dim"][i].as_py()
                    if dim not in by_dim:
                        continue
                    places, q = by_dim[dim]
                    shard = {name: batch[name][i].values for name in ("ids", "owners", "vectors", "layers", "links", "loose")}
                    numbers, ids, scores = _answers(shard, q, [all_ids[p] for p in places], k, ef)
                    numbers = [int(places[n]) for n in numbers]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(numbers, pa.int32()), pa.array([all_ids[n] for n in numbers], held_type), pa.array(ids, shard["ids"].type),
                        pa.array(scores, pa.float64())], names=["q", "query_id", "id", "score"])

        held_type = held["id"].type
        index.mapInArrow(run, schema).write.parquet(f"{found}/block={block}")
        sent.unpersist()
    best = spark.read.schema(f"{schema}, block int").parquet(found) if present else spark.createDataFrame([], f"{schema}, block int")
    rank = F.row_number().over(Window.partitionBy("block", "q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op12_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The five nearest rows of all ``embeddings`` for every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search_index(build_index(rows), rows.where(F.col("vec_id") % 50 == 0))
