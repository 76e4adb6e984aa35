"""File sources and sinks.

All raw extracts are headered UTF-8 CSV read as strings (no inference); the CSV null-token
list becomes SQL NULL once per source.  The driver lists files; headers and rows are read by
Spark's own readers, on any file system that Spark can read.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions import dictionaries as D
from riskmart.functions.scalars import na_to_null, snake_case_columns
from riskmart.session import written


# ------------------------------------------------------------------ listing and headers
#: Place of a row in the source: path, block of the file, and row within the block.
SOURCE_ORDER = ["src_file", "src_block", "src_row"]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def list_csv_files(spark: SparkSession, folder: str | Sequence[str]) -> list[str]:
    """Sorted ``*.csv`` paths in the folder or folders (Hadoop FS, so local or object stores alike)."""
    found = []
    for one in [folder] if isinstance(folder, str) else folder:
        fs, p = _fs(spark, one)
        if fs.exists(p):
            found += [str(s.getPath().toString()) for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().endswith(".csv")]
    return sorted(found)


#: As openCostInBytes and maxPartitionBytes: a file is never split, and no two files share a task.
_FILE_A_TASK = str(1 << 40)


def first_records(spark: SparkSession, files: Sequence[str], records: int) -> dict[tuple, list[str]]:
    """Files by the cells of their first ``records`` records.

    Spark's text reader reads them, a file a task, and a task ends as soon as it has its records:
    after one batch of lines, whatever the file's size.  The driver receives a row for each
    distinct head and one (path, head number) for each file, as it does from the listing.
    """
    if not files:
        return {}

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import csv
        import itertools

        import pyarrow as pa
        path: list[str] = []

        def lines() -> Iterator[str]:
            for batch in batches:
                if batch.num_rows and not path:
                    path.append(batch["path"][0].as_py())
                for line in batch["value"].to_pylist():
                    yield line + "\n"

        rows = ([cell.removeprefix("\ufeff") for cell in row] for row in csv.reader(lines()) if row)  # blank lines are no records
        head = list(itertools.islice(rows, records))
        if path:
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array([head], pa.list_(pa.list_(pa.string())))], names=["path", "head"])

    alone = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        alone.conf.set(f"spark.sql.files.{name}", _FILE_A_TASK)
    text = alone.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("path"))
    found = written(text.mapInArrow(heads, "path string, head array<array<string>>").withColumn("id", F.xxhash64("head")), "heads", session=spark)
    distinct = {r.id: tuple(tuple(row) for row in r.head) for r in found.groupBy("id").agg(F.first("head").alias("head")).collect()}
    names, path_of = {}, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for f in files:  # the reader gives qualified URIs
        fs, at = _fs(spark, f)
        names[str(path_of(fs.makeQualified(at).toString()).toUri().toString())] = f
    groups: dict[tuple, list[str]] = {}
    for r in found.select("path", "id").orderBy("path").collect():
        groups.setdefault(distinct[r.id], []).append(names[r.path])
    return groups


def _read_strings(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], header: bool, multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    raw = (spark.read.schema(schema).option("header", header).option("multiLine", multi_line)
           .option("escape", '"').option("nullValue", None).csv(list(paths)))
    # attached here, file by file: a union of groups has no file metadata
    order = [F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("src_block"),
             F.monotonically_increasing_id().alias("src_row"), F.col("_metadata.file_name").alias("raw_file_name")]
    return raw.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in columns], *order)


def empty_frame(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.createDataFrame([], schema)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ S1 / S2 / S5 / P7
def read_csv_folder(spark: SparkSession, folder: str | Sequence[str], lineage: bool = False, columns_if_empty: Sequence[str] = (),
                    order: bool = False, multi_line: bool = False) -> DataFrame:
    """All ``*.csv`` in a folder, as strings, unioned by column name (schema drift, P7).

    Files are grouped by header so each group is one distributed read.  ``lineage`` adds
    ``raw_file_name`` (S2) and ``order`` the ``SOURCE_ORDER`` columns for keep-first.  Quoted
    line ends need ``multi_line``, which reads every file in one task.  No files -> an empty
    frame with ``columns_if_empty``.
    """
    extra = (["raw_file_name"] if lineage else []) + (SOURCE_ORDER if order else [])
    files = list_csv_files(spark, folder)
    if not files:
        return empty_frame(spark, [*columns_if_empty, *extra])
    frames = []
    for head, paths in sorted(first_records(spark, files, 1).items()):
        columns = list(head[0]) if head else []
        if columns:  # an empty file has no header
            frames.append(_read_strings(spark, paths, columns, True, multi_line).select(*[f"`{c}`" for c in columns], *extra))
    return _union(frames) if frames else empty_frame(spark, [*columns_if_empty, *extra])


def read_raw_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """S1 + snake_case names, no de-duplication."""
    return snake_case_columns(read_csv_folder(spark, folder))


# ------------------------------------------------------------------ S3 two-row header
def flatten_two_row_header(top: Sequence[str | None], bottom: Sequence[str | None]) -> list[str]:
    """``top_bottom`` when both are set, otherwise whichever is set."""
    rows = [[(cell or "").strip() for cell in row] for row in (top, bottom)]
    return ["_".join(filter(None, column)) for column in zip(*rows)]


def _without_first(raw: DataFrame, records: int) -> DataFrame:
    """``raw`` without the first ``records`` records of every file.

    The rows of a file's first block reach one task in the order of the file, so their place
    is counted as they pass: one scan, no shuffle, and nothing that depends on how blocks are
    dealt to tasks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        path, passed = None, 0  # the file that the task is in and its records so far
        for batch in batches:
            at = np.flatnonzero(batch["src_block"].to_numpy() == 0)
            if path is not None and passed >= records and batch.num_rows and batch["src_file"][0].as_py() == batch["src_file"][-1].as_py() == path:
                yield batch
                continue
            keep = np.ones(batch.num_rows, bool)
            files = batch["src_file"].to_pylist()
            for i in at.tolist():
                if files[i] != path:
                    path, passed = files[i], 0
                keep[i] = passed >= records
                passed += 1
            yield batch.filter(pa.array(keep))

    return raw.mapInArrow(run, raw.schema)


def read_two_row_header_exports(spark: SparkSession, folder: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Exports whose rows 1-2 are a split header and row 3 a separator; data from row 4.

    Files are grouped by their two header rows and read once; their first three records are left
    out by their place in the file.  All-NULL rows are dropped.  The
    ``SOURCE_ORDER`` columns are returned for keep-first de-duplication.
    """
    files = list_csv_files(spark, folder)
    frames = []
    for head, paths in sorted(first_records(spark, files, 2).items()):
        if len(head) < 2:
            continue
        names = flatten_two_row_header(*itertools.zip_longest(*itertools.zip_longest(*head)))
        raw = _read_strings(spark, paths, [f"_c{i}" for i in range(len(names))], False, multi_line)
        data = _without_first(raw, 3)
        named = [(i, n) for i, n in enumerate(names) if n]
        part = data.select(*[F.col(f"_c{i}").alias(n) for i, n in named], "raw_file_name", *SOURCE_ORDER)
        frames.append(part.dropna(how="all", subset=[n for _, n in named]))
    return _union(frames) if frames else empty_frame(spark, ["raw_file_name"])


# ------------------------------------------------------------------ S4 three-table source
def read_investigation_files(spark: SparkSession, folder: str):
    """(events, aircraft, injury, raw_file_name) from the three fixed file names; None if absent.

    A name may be one file or a folder of part files; each table has the ``SOURCE_ORDER`` columns.
    """
    def table_of(name: str) -> DataFrame | None:
        path = os.path.join(folder, name)
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            return None
        files = [path] if fs.getFileStatus(p).isFile() else list_csv_files(spark, path)
        frames = [_read_strings(spark, paths, head[0], True, False) for head, paths in sorted(first_records(spark, files, 1).items()) if head]
        return snake_case_columns(_union(frames).drop("raw_file_name")) if frames else None

    tables = [table_of(n) for n in D.INVESTIGATION_FILES]
    if tables[0] is None:
        return None, None, None, ""
    return *tables, "|".join(n for n, t in zip(D.INVESTIGATION_FILES, tables) if t is not None)


# ------------------------------------------------------------------ S6 curated layer
def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Parquet table of a previous layer; missing -> typed empty frame (or None without a schema)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema) if schema is not None else None


# ------------------------------------------------------------------ S7 / S8 sinks
def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite; an empty input still writes (a header-only CSV / empty Parquet), never stale."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        w.format(fmt).save(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row (nested) summary as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


# ------------------------------------------------------------------ S9 BI extract
def overview_extract(overview: DataFrame) -> DataFrame:
    """The dashboard's 17 typed columns: month as a date, three strings, every measure real."""
    measures = [c for c in overview.columns if c not in ("report_month", "airport", "region", "data_basis")]
    return overview.select(
        F.to_date(F.concat(F.col("report_month"), F.lit("-01"))).alias("report_month"),
        F.col("airport").cast("string"), F.col("region").cast("string"),
        *[F.col(c).cast("double").alias(c) for c in measures],
        F.col("data_basis").cast("string"),
    )
