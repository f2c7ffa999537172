"""Column builders: each takes columns and returns native Catalyst expressions."""

from marketlens.functions.aggregates import (
    count_where,
    distinct_values,
    exact_mean,
    grid_point,
    pct_where,
    pooled_ratio,
)
from marketlens.functions.bands import (
    AGE_BANDS,
    GROUP_SIZE_BANDS,
    LIST_LENGTH_BANDS,
    PRICE_BANDS,
    REVIEW_BANDS,
    Bands,
)
from marketlens.functions.cleaning import (
    cents_to_units,
    flags_from_struct,
    is_integer_text,
    json_to_map,
    normalise_name,
    parse_bounded_int,
    parse_bracket,
    parse_date_shapes,
    split_list,
)
from marketlens.functions.labels import AGE_GATED_TAGS, MATURE_TAGS, has_any_label
from marketlens.functions.ordering import order_key
from marketlens.functions.scoring import positive_ratio, value_proxy, wilson_lower_bound

__all__ = [
    "AGE_BANDS",
    "AGE_GATED_TAGS",
    "Bands",
    "GROUP_SIZE_BANDS",
    "LIST_LENGTH_BANDS",
    "MATURE_TAGS",
    "PRICE_BANDS",
    "REVIEW_BANDS",
    "cents_to_units",
    "count_where",
    "distinct_values",
    "exact_mean",
    "flags_from_struct",
    "grid_point",
    "has_any_label",
    "is_integer_text",
    "json_to_map",
    "normalise_name",
    "order_key",
    "parse_bounded_int",
    "parse_bracket",
    "parse_date_shapes",
    "pct_where",
    "pooled_ratio",
    "positive_ratio",
    "split_list",
    "value_proxy",
    "wilson_lower_bound",
]
