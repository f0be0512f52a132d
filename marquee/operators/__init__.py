"""DataFrame -> DataFrame operators for nested data."""

from marquee.operators.exact import exact_means, exact_sums
from marquee.operators.nesting import (
    attach_grouped, collect_sorted, collect_sorted_in_parts, embed_children, invert_array, lookup_array, lookup_in_array, nest, unwind,
)
from marquee.operators.joins import left_join_salted, left_join_spread_nulls
from marquee.operators.sets import union_with
from marquee.operators.topk import top_k

__all__ = ["exact_means", "exact_sums", "attach_grouped", "collect_sorted", "collect_sorted_in_parts", "embed_children", "invert_array", "lookup_array", "lookup_in_array", "nest",
           "unwind", "union_with", "top_k", "left_join_salted", "left_join_spread_nulls"]
