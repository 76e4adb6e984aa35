"""op7: document fingerprints by Order MinHash.

Every k-mer of code points gets an occurrence number, so the k-mers of a text are distinct.
Each of ``m`` hash functions selects the ``l`` smallest numbered k-mers; their plain k-mers,
put back in text order, are hashed as a tuple, which is one element of the signature.  Two
texts agree in an element if they share the selected k-mers in the same order, so the share
of equal elements falls with edits and with moved blocks, not only with changed content.

The neighbour of a document is the next by doc_id.  Texts are dealt to ranges of doc_id once;
each range also gets the first document of the one after it, so no window over all
rows and no join of texts is needed.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import ship, table, texts

K, L, M, SEED = 10, 2, 64, 20240229
_U = np.uint64
_MASK = (1 << 64) - 1


def _mixers(m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return (rng.integers(0, 1 << 32, m, dtype=np.uint32), rng.integers(0, 1 << 31, m, dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def kmer_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every window of k code points; one of the whole text if it is shorter."""
    base = 0x9E3779B97F4A7C15
    h = _mix(codes.astype(np.uint64) + _U(1))
    out, done, width = None, 0, 1  # windows of k as windows of powers of two
    power = base
    k = min(k, len(codes))
    while True:
        if k & width:
            part = h[done: len(codes) - (k - done) + 1] if done else h[: len(codes) - k + 1]
            out = part.copy() if out is None else out * _U(power) + part
            done += width
        if done == k:
            return _mix(out + _U(k))
        h = h[:-width] * _U(power) + h[width:]
        power = power * power & _MASK
        width *= 2


class OrderMinHash:
    """Signatures of texts; ``m`` elements of 16 bits each, as lowercase hex."""

    def __init__(self, k: int = K, l: int = L, m: int = M, seed: int = SEED):
        self.k, self.l, self.m = k, l, m
        self.flip, self.scale = _mixers(m, seed)

    def __call__(self, text: str) -> str:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(codes):
            return ""
        return self.signature(codes)

    def signature(self, codes: np.ndarray) -> str:
        hashes = kmer_hashes(codes, self.k)
        n = len(hashes)
        bits = max(20, n.bit_length())
        order = np.sort((hashes >> _U(bits) << _U(bits)) | np.arange(n, dtype=np.uint64))
        kmer, at = order >> _U(bits), (order & _U((1 << bits) - 1)).astype(np.int64)
        index = np.arange(n)
        first = np.ones(n, bool)
        first[1:] = kmer[1:] != kmer[:-1]
        occurrence = index - np.maximum.accumulate(np.where(first, index, 0))
        numbered = (_mix(kmer * _U(0x9E3779B97F4A7C15) + occurrence.astype(np.uint64)) >> _U(32)).astype(np.uint32)
        l = min(self.l, n)
        chosen = np.empty((l, self.m), np.int64)
        step = max(1, 2_000_000 // n)
        for j in range(0, self.m, step):
            rank = (numbered[None, :] ^ self.flip[j:j + step, None]) * self.scale[j:j + step, None]
            rows = np.arange(len(rank))
            for i in range(l):
                chosen[i, j:j + step] = low = rank.argmin(axis=1)
                rank[rows, low] = 0xFFFFFFFF
        chosen = np.take_along_axis(chosen, np.argsort(at[chosen], axis=0), axis=0)  # text order
        element = np.zeros(self.m, np.uint64)
        for row in chosen:
            element = _mix(element * _U(0xD6E8FEB86659FD93) + kmer[row] + _U(1))
        return (element >> _U(48)).astype(">u2").tobytes().hex()

    def likeness(self, a: str, b: str) -> float:
        """Share of equal elements; two empty texts are alike (1), an empty and another not (0)."""
        if not a or not b:
            return float(a == b)
        x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
        return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) characters replaced by the first ones of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


#: A range holds about so many bytes of text; there are at most so many ranges.
RANGE_BYTES, MAX_RANGES = 16 << 20, 4096
_LOWEST = -1.7976931348623157e308


def _position(docs: DataFrame) -> Column:
    """A double that does not fall along the order of ``id``: for text, the bytes after what all ids begin with."""
    kind, c = docs.schema["id"].dataType, F.col("id")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        ends = docs.agg(F.min(c.cast("binary")).alias("low"), F.max(c.cast("binary")).alias("high")).first()
        shared = len(os.path.commonprefix([bytes(ends.low or b""), bytes(ends.high or b"")]))
        at = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), shared + 1, 6)), 12, "0"), 16, 10).cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        at = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        at = c.cast("double")
    else:
        at = F.lit(0.0)
    return F.when(c.isNull(), F.lit(_LOWEST)).when(F.isnan(at), F.lit(-_LOWEST)).otherwise(F.greatest(F.least(at, F.lit(-_LOWEST)), F.lit(_LOWEST)))


def _ranges(docs: DataFrame, bounds: list[float]) -> DataFrame:
    """``docs`` with part, the index of the range of ``ord`` (monotone; a binary search in the JVM)."""
    if not bounds:
        return docs.withColumn("part", F.lit(0))
    from pyspark.ml.feature import Bucketizer
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="ord", outputCol="part_d")
    return cut.transform(docs).withColumn("part", F.col("part_d").cast("int")).drop("part_d")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sketch: OrderMinHash | None = None, ranges: int | None = None) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Documents are in the order of ``id_col`` (any type that Spark orders; null first, equal ids by
    text); the last is followed by the first.  A null text counts as empty, whose fingerprint is the
    empty string.  Other columns are not read.  The order is cut into ranges of about
    ``RANGE_BYTES`` of text (or into ``ranges``), a task each; rows of one id stay in one range.
    """
    spark = df.sparkSession
    ship(spark)
    sketch = sketch or OrderMinHash()
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    docs = docs.withColumn("ord", _position(docs))
    id_type = docs.schema["id"].dataType.simpleString()
    held = docs.agg(F.percentile_approx("ord", [i / MAX_RANGES for i in range(1, MAX_RANGES)], 20_000).alias("at"), F.sum(F.octet_length("body")).alias("size")).first()
    n = min(MAX_RANGES, ranges or max(-(-(held.size or 0) // RANGE_BYTES), spark.sparkContext.defaultParallelism))
    bounds = sorted({held["at"][round(i * MAX_RANGES / n) - 1] for i in range(1, n)} - {_LOWEST}) if held["at"] else []
    dealt = _ranges(docs, bounds)
    lows = sorted((r.part, r.low) for r in dealt.groupBy("part").agg(F.min("ord").alias("low")).collect())  # a row per range
    ahead = [(low, lows[i - 1][0]) for i, (_, low) in enumerate(lows)]
    look = spark.createDataFrame(ahead or [(0.0, -1)], "low double, before int")
    first = F.min(F.struct("id", "body"))  # of the rows at a range's lowest position
    copies = dealt.join(F.broadcast(look), F.col("ord") == F.col("low")).groupBy(F.col("before").alias("part")).agg(first.alias("first")).select(
        "first.id", "first.body", "part", F.lit(1).alias("turn"))
    rows = dealt.select("id", "body", "part", F.lit(0).alias("turn")).unionByName(copies)
    rows = rows.repartitionById(max(1, len(bounds) + 1), "part").sortWithinPartitions("turn", F.col("id").asc_nulls_first(), "body")
    schema = (f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # id, text, fingerprint
        for batch in batches:
            out = []
            for doc, text, turn in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist()):
                if held is None and turn:
                    break
                mark = held[2] if held and held[1] == text else sketch(text)
                if held:
                    new = edited(held[1], text)
                    other = sketch(new)
                    out.append((held[0], len(held[1]), hashlib.sha256(new.encode()).hexdigest(), held[2], other,
                                sketch.likeness(held[2], other), sketch.likeness(held[2], mark)))
                held = None if turn else (doc, text, mark)
                if turn:
                    break
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)

    probe = spark.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(probe.schema)
    types, names = arrow.types, arrow.names
    return rows.select("id", "body", "turn").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all ``documents`` and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
