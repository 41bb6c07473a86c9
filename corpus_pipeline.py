"""Corpus pipeline: five of the operators, one after the other, over ``documents``.

Each stage reads what its predecessor kept, lets its decisions take effect and
returns the columns of its input, but for the last, which returns ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.llm.common import remove, staged_tables_removed
from beatwise.llm.decontaminate import remove_leaked
from beatwise.llm.host_quality import judge_hosts
from beatwise.llm.pieces import encode_decode
from beatwise.llm.secrets import mask_secrets
from beatwise.llm.simhash import near_duplicates
from beatwise.session import staging_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict keep."""
    verdict = max(("verdict", *docs.columns), key=len) + "_"  # no column's name
    return judge_hosts(docs, out=verdict).filter(F.col(f"`{verdict}`.kept")).drop(verdict)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: a row with the group's smallest id, or any if none has one.

    Groups are found on ids and hashes of rows; the texts are shuffled once,
    to keep the chosen rows.  Of several rows with the smallest id the one
    with the smallest hash of all its columns stays; rows equal in all columns
    meet in each task before the shuffle and are one.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), "text").withColumn("mark", F.xxhash64("doc"))
    classes = near_duplicates(rows.select("id", "mark", "text"), id_col="id", shingle=3, max_bits=2,
                              keep=["id", "mark"], root="root")
    least = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "mark")).alias("least")
    place = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("none")), "mark").alias("place")
    stay = classes.groupBy("root").agg(least).select("least.*").select(place)
    once = rows.select("doc", place).groupBy("place").agg(F.first("doc").alias("doc"))
    return once.join(stay, "place").select("doc.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified passage of the benchmark."""
    return remove_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return mask_secrets(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and whether they decode to its text."""
    coded = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"),
                        encode_decode(F.col("text"), PIECES).alias("pieces"))
    return coded.select("doc_id", "lang", "source", F.col("pieces.ids").alias("ids"),
                        F.size("pieces.ids").cast("long").alias("n_tokens"),
                        (F.col("pieces.decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints, BM25 thresholds, the forest and the ids are beyond SQL; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each writes Parquet that the next reads, then goes."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        with staged_tables_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
