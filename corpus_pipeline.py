"""The corpus pipeline: quality classifier, n-gram Jaccard join, secret scans, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs.  All but the last return the columns of their input.
Columns of the input that clash with a stage's own names are kept under their names.  No
stage can be expressed in SQL as a whole (a learnt model, a tokenizer), so there is no
ORACLE_SQL; ``tests/llm`` holds the pipeline against brute force.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.bpe import RANKS, bpe_round_trip
from riskmart.llm.common import broadcast_below, fresh, materialize, table
from riskmart.llm.jaccard_join import jaccard_components
from riskmart.llm.mixing import mix_sources
from riskmart.llm.quality import quality_model, score_quality
from riskmart.llm.secrets_scan import scan_secrets

SECRET_MASK = "[SECRET]"


def _around(docs: DataFrame, new: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` over ``docs`` whose columns named as in ``new`` are set aside and come back."""
    clash = [c for c in docs.columns if c in new]
    aside = dict(zip(clash, fresh(docs, *[f"kept_{c}" for c in clash])))
    out = step(docs.withColumnsRenamed(aside))
    return out.drop(*new).withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking learnt from ``labels`` does not reject."""
    ranking = quality_model(docs, table(spark, sf_dir, "labels"))
    return _around(docs, ("held_out", "score", "predicted"), lambda d: score_quality(d, ranking).where("predicted = 1"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Documents without words are no duplicates and stay, as do those without an id.  If an id
    occurs with several texts, only those that are near-duplicates go.  Of
    repeated rows (equal id and text) one stays.
    """
    groups = materialize(jaccard_components(docs, with_digest=True), "pipeline-groups")
    out = groups.where("doc_id is not null and doc_id <> component_id").select(F.col("doc_id").alias("out_id"), F.col("text_digest").alias("out_digest")).distinct()
    removed = (F.col("doc_id") == F.col("out_id")) & (F.md5(F.col("text").cast("binary")) == F.col("out_digest"))
    kept = docs.join(broadcast_below(out), removed, "left_anti")
    again = materialize(groups.where("doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias("again_id")).count().where("count > 1").select("again_id"), "pipeline-again")
    if again.isEmpty():
        return kept
    same = F.col("doc_id") == F.col("again_id")
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked and n_chars counted anew."""
    new = ("n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans")
    masked = _around(docs, new, lambda d: scan_secrets(d, mask=SECRET_MASK))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return masked.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it (0, 1 or 2 times)."""
    def mix(d: DataFrame) -> DataFrame:
        return mix_sources(d).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    return _around(docs, ("size", "source_size", "target", "copies", "taken"), mix)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with the digests of the ids and of their decoding."""
    import public_tokenizers
    return bpe_round_trip(docs.select("doc_id", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
