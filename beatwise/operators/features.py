"""Flattening of feature collections (GeoJSON-like documents)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def explode_features(docs: DataFrame, features_col: str = "features") -> DataFrame:
    """One row per element of the ``features`` array, struct fields as columns."""
    return docs.selectExpr(f"inline(`{features_col}`)")


def flatten_properties(features: DataFrame, struct_col: str = "properties",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Promote every field of ``struct_col`` to a top-level column.

    New properties appear without code changes.  ``keep`` names other
    top-level columns to carry along; everything else (``type``,
    ``geometry``, ...) is dropped and therefore never read.
    """
    return features.select(f"{struct_col}.*", *keep)
