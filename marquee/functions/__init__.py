"""Column -> Column functions over nested values."""

from marquee.functions.arrays import (
    Key, asc, concat_arrays, desc, elem_match, elements_where, field_min, parse_characters,
    round_half_even, sort_column, sort_elements, split_list, top_k_elements,
)

__all__ = ["Key", "asc", "concat_arrays", "desc", "elem_match", "elements_where", "field_min",
           "parse_characters", "round_half_even", "sort_column", "sort_elements", "split_list", "top_k_elements"]
