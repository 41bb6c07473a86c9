"""Registered queries: one per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_repeats, suffix_repeats
from .centroids import cluster
from .decontaminate import find_leaks
from .host_quality import judge_hosts
from .mixing import mix_sources
from .pieces import encode_decode
from .pseudo_likelihood import score_documents
from .secrets import scan
from .shards import assign_shards
from .simhash import near_duplicates
from .spellings import LOSES_LETTER, spelling_variants
from .warc import archive_folder, mark_revisits, read_archives, write_archives

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive and back."""
    records = mark_revisits(_read(spark, sf_dir, "pages"))
    back = read_archives(write_archives(records, archive_folder(spark)), payload=False)
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"), "digest_ok")


def pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed log-probability of every document under a network trained on all of them."""
    scored = score_documents(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return scored.select("doc_id", F.col("score.tokens").alias("n_tokens"),
                         F.round("score.log_probability", 3).alias("log_probability"),
                         F.round("score.per_token", 6).alias("per_token"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    assigned = assign_shards(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return assigned.select("doc_id", F.col("shard.name").alias("shard"), F.col("shard.depth").alias("depth"),
                           F.col("shard.bytes").alias("shard_bytes"))


def host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    judged = judge_hosts(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "kept"]
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in names if c != "host_rate"])


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with score and overlaps."""
    return find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", encode_decode(F.col("text"), PIECES).alias("pieces"))
    return docs.select(
        "doc_id", F.size("pieces.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("pieces.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256"))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, max_bits=2, keep=["doc_id"])


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text", "source")
    return scan(docs).select(F.col("key").alias("doc_id"), "offset", "candidate",
                             F.round("probability", 6).alias("probability"), "is_secret")


def block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, digest of what is left."""
    cut = block_repeats.remove_repeats(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)
    return cut.select("row.doc_id", "n_words", removed.alias("n_removed"),
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, digest of what is left."""
    cut = suffix_repeats.remove_repeats(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)
    return cut.select("row.doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector, with what its cluster adds up to."""
    found = cluster(_read(spark, sf_dir, "embeddings"), dimensions=64, k=40, rounds=5, seed=2, keep=["vec_id"])
    return found.select("vec_id", F.col("cluster.number").alias("cluster"), F.col("cluster.distance").alias("distance"),
                        F.col("cluster.inertia").alias("cluster_inertia"), F.col("cluster.total_inertia").alias("inertia"),
                        F.col("cluster.centroid_sha256").alias("centroid_sha256"))


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its more frequent form and the root of its forms."""
    return spelling_variants(_read(spark, sf_dir, "documents"), loses_letter=LOSES_LETTER)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix_sources(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", *[F.col(f"mix.{c}").alias(c) for c in ("size", "source_size", "target", "taken")])


QUERIES = {
    "op1_warc": warc,
    "op2_pseudo_likelihood": pseudo_likelihood,
    "op3_sharding": sharding,
    "op4_decontaminate": decontaminate,
    "op5_host_quality": host_quality,
    "op6_sentencepiece": sentencepiece,
    "op7_simhash": simhash,
    "op8_block_anchors": block_anchors,
    "op9_suffix_dedup": suffix_dedup,
    "op10_secret_scan": secret_scan,
    "op11_centroid_clusters": centroid_clusters,
    "op12_spelling_groups": spelling_groups,
    "op13_source_mix": source_mix,
}
