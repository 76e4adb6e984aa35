"""Helpers shared by the training-data operators.

Intermediate tables go to the shared folder of ``spark.checkpoint.dir`` as Parquet, so a
lost executor only costs the tasks that read them again.  The folder is the cluster's own
setting; a local run without one gets a folder of its own, a cluster without one is an
error.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a local session, once for each application.

    On a cluster the package is installed or submitted with ``--py-files``, as any other.
    """
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster") or context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    with tempfile.TemporaryDirectory() as folder:
        staged = Path(folder, "staged")
        shutil.copytree(root / "riskmart", staged / "riskmart", ignore=shutil.ignore_patterns("__pycache__"))
        name = f"riskmart-{context.applicationId}"
        archive = shutil.make_archive(os.path.join(folder, name), "zip", staged)
        kept = shutil.copy(archive, tempfile.mkdtemp(prefix="riskmart-code-"))
    context.addPyFile(kept)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="riskmart-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/riskmart-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = path or new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that a later one has replaced."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: A table is broadcast up to so many bytes of its values.
BROADCAST_BYTES = 16 << 20


def _width(df: DataFrame) -> Column:
    """Bytes of a row's values: 8 a number, the length of a string, that of the JSON of anything nested."""
    flat = sum(16 for f in df.schema if not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)))
    texts = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))) for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) + 16 for c in texts + nested], F.lit(flat))


def broadcast_below(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the values of the (materialised, narrow) table take at most ``max_bytes``.

    Above that the planner joins by shuffle with AQE's skew splitting; results are equal.
    """
    taken = df.agg(F.sum(_width(df).cast("long"))).first()[0] or 0
    return F.broadcast(df) if taken <= max_bytes else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names not in ``df`` yet, one for each of ``names`` (clashing extra columns)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a task holds few texts at a time.

    Memory that Arrow keeps for later goes back to the system when the task ends.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """One table per run of equal ``keys`` in a stream of batches sorted by them.

    Holds one group at a time; groups here are tiles whose size the caller bounds.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        ids = list(zip(*cols))
        start = 0
        for i, k in enumerate(ids):
            if k != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, k
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round of large-star or small-star over edges (hi, lo) with hi > lo."""
    if large:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out_edges = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        low = out_edges.groupBy("u").agg(F.min("v").alias("m"))
        out = out_edges.join(low, "u").where("v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(
            low.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.distinct()


def components(edges: DataFrame, a: str, b: str, tag: str) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    Returns (node, root): the smallest node of each component for every node that has an
    edge.  Each round is joins and map-side combined minima; the edge table of a round is
    written to the shared folder, and only its row count and checksum reach the driver.
    """
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    e = materialize(e, f"{tag}-edges")

    def mark(t: DataFrame):
        return t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()

    before = mark(e)
    while before[0]:
        e = materialize(_star(_star(e, True), False), f"{tag}-edges")
        after = mark(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)


def words_pattern() -> str:
    """A word of the contracts: a maximal run without space, tab, LF, VT, FF and CR."""
    return r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(words_pattern())), F.lit(0)).cast("long")
