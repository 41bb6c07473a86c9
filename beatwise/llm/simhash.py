"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint and every fingerprint within half the radius of it are its
variants.  Two fingerprints within the radius share a variant, so a shuffle on
variants brings every linked pair together.

Defined results:

* null or empty text: no words, fingerprint zero, linked like any other;
* fewer words than a shingle: the whole sequence is the one shingle;
* equal fingerprints meet before the shuffle, so a group of copies of any
  size is one row there; of a variant at most 65 fingerprints exist (radius 2);
* repeated rows share a component; a null id takes part in links, and a
  component of null ids only has a null component;
* columns called like the outputs are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pack
from .graph import connected_components

#: Fixed value: seed of the shingle hash.
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)
    else:
        spans = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    ones = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:  # sums of 255 rows fit one byte, which adds fast
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_udf(shingle: int):
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return simhash


def ball_masks(radius: int) -> list[int]:
    """Signed 64-bit masks of at most ``radius`` set bits, zero first."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Verified links ``(a, b)``, a < b, between the distinct fingerprints ``fp``.

    Within a variant neighbours in order are paired, not all pairs: enough for
    connectivity where the variant ball's diameter is within ``max_bits``
    (every even radius); an odd radius also pairs all members of a variant,
    whose number the ball's size bounds.
    """
    half = (max_bits + 1) // 2
    masks = F.array(*[F.lit(m) for m in ball_masks(half)])
    variants = prints.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    if max_bits % 2 == 0:
        order = Window.partitionBy("variant").orderBy("fp")
        pairs = variants.select(F.lag("fp").over(order).alias("a"), F.col("fp").alias("b")).filter("a IS NOT NULL")
    else:
        left, right = variants.withColumnRenamed("fp", "a"), variants.withColumnRenamed("fp", "b")
        pairs = left.join(right, "variant").filter("a < b").select("a", "b")
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2, keep: list[str] | None = None, root: str | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) plus ``fingerprint`` (hex) and ``component_id``.

    ``component_id`` is the smallest id that links reach, itself included.
    ``root`` names a further column: a number that a component's rows share,
    whether they have ids or not, and no other's.
    """
    keep = [c for c in keep or df.columns if c.lower() not in ("fingerprint", "component_id")]
    marked = materialize(pack(df, keep, id=F.col(id_col), fp=_fingerprint_udf(shingle)(F.col(text).cast("binary"))),
                         "simhash")
    prints = materialize(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "prints")
    edges = materialize(links(prints.select("fp"), max_bits), "links")
    roots = connected_components(edges)  # node, root: only of linked fingerprints
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(best, "root").select("fp", "component_id", "root")
    return marked.join(classes, "fp").select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        *([F.col("root").alias(root)] if root else []))
