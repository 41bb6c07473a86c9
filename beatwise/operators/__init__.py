"""DataFrame -> DataFrame building blocks."""

from beatwise.operators.features import explode_features, flatten_properties
from beatwise.operators.joins import JOIN_STRATEGIES, join_by_key
from beatwise.operators.nearest import nearest_site, prepare_points
from beatwise.operators.share import share_of_total
from beatwise.operators.topk import top_k_per_group

__all__ = [
    "explode_features", "flatten_properties", "JOIN_STRATEGIES", "join_by_key",
    "nearest_site", "prepare_points", "share_of_total", "top_k_per_group",
]
