"""Column functions over nested values: array predicates, element sorts, lists.

All are built-in Spark expressions (higher-order functions included), so they
run inside the JVM on each row's array without any shuffle.

Inside an element lambda, reach fields with ``p["name"]``, never ``p.name``:
attribute access resolves to the ``Column`` method of that name when one
exists (``name``, ``alias``, ``cast`` ...), and the predicate silently becomes
a constant.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Pred = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: Column | str, sep: str = ",") -> Column:
    """Comma list → array of strings; null stays null, '' becomes ['']."""
    return F.split(_col(c), sep)


def parse_characters(c: Column | str) -> Column:
    """JSON array text → array<string>; malformed or null text → null."""
    return F.from_json(_col(c), "array<string>")


def elem_match(arr: Column | str, pred: Pred) -> Column:
    """True when any element satisfies ``pred`` (all conditions on one element).

    A null array gives null, which a filter treats as false.
    """
    return F.exists(_col(arr), pred)


def elements_where(arr: Column | str, pred: Pred) -> Column:
    return F.filter(_col(arr), pred)


def field_path(x: Column, path: str) -> Column:
    for part in path.split("."):
        x = x[part]
    return x


def field_min(arr: Column | str, path: str, where: Pred | None = None) -> Column:
    """Smallest value of one element field, optionally over matching elements
    only; nulls are ignored and no value gives null."""
    a = _col(arr)
    if where is not None:
        a = F.filter(a, where)
    return F.array_min(F.transform(a, lambda x: field_path(x, path)))


def concat_arrays(*arrs: Column | str) -> Column:
    """Concatenate arrays, a null one counting as empty."""
    return F.flatten(F.filter(F.array(*[_col(a) for a in arrs]), lambda a: a.isNotNull()))


#: Ratings are added up as decimals with four places and up to fourteen digits
#: before the point, so a sum is the same in any order.
EXACT = "decimal(8,4)"


def exact_sum(c: Column | str) -> Column:
    """Sum of ratings (an aggregate) that does not depend on the order of rows.

    A value that does not fit four places before and after the point raises an
    error instead of being rounded; sum such doubles with
    ``operators.exact_sums``."""
    whole = _col(c).try_cast(EXACT)
    lost = F.raise_error(F.concat(F.lit("not exact as a rating: "), _col(c).cast("string"))).cast(EXACT)
    return F.sum(F.when(_col(c).isNull() | F.coalesce(whole.cast("double") == _col(c), F.lit(False)), whole).otherwise(lost))


def exact_mean(total: Column, n: Column) -> Column:
    """A decimal sum over a count, divided once, as a double; null for none."""
    return F.try_divide(total.cast("double"), n)


def round_half_even(c: Column | str, scale: int = 2) -> Column:
    """Round with ties to even (6.825 → 6.82), the rule of document stores."""
    return F.bround(_col(c), scale)


@dataclass(frozen=True)
class Key:
    """One sort key over array elements: a field path, a direction and where
    nulls go (default: first when ascending, last when descending)."""

    path: str
    descending: bool = False
    nulls_last: bool | None = None

    @property
    def _nulls_last(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last


def sort_column(key: Key) -> Column:
    """The same key as a row sort order (``orderBy``, window ``ORDER BY``)."""
    c = F.col(key.path)
    if key.descending:
        return c.desc_nulls_last() if key._nulls_last else c.desc_nulls_first()
    return c.asc_nulls_last() if key._nulls_last else c.asc_nulls_first()


def asc(path: str, nulls_last: bool = False) -> Key:
    return Key(path, False, nulls_last)


def desc(path: str, nulls_last: bool = True) -> Key:
    return Key(path, True, nulls_last)


def _compare(left: Column, right: Column, key: Key) -> Column:
    lv, rv = field_path(left, key.path), field_path(right, key.path)
    null_side = 1 if key._nulls_last else -1
    direction = -1 if key.descending else 1
    return (
        F.when(lv.isNull() & rv.isNull(), F.lit(0))
        .when(lv.isNull(), F.lit(null_side))
        .when(rv.isNull(), F.lit(-null_side))
        .when(lv < rv, F.lit(-direction))
        .when(lv > rv, F.lit(direction))
        .otherwise(F.lit(0))
    )


def sort_elements(arr: Column | str, *keys: Key) -> Column:
    """Sort each row's array by several keys, each with its own direction and
    null placement."""
    if not keys:
        return F.sort_array(_col(arr))

    def comparator(left: Column, right: Column) -> Column:
        acc = _compare(left, right, keys[-1])
        for key in reversed(keys[:-1]):
            c = _compare(left, right, key)
            acc = F.when(c != 0, c).otherwise(acc)
        return acc

    return F.array_sort(_col(arr), comparator)


def top_k_elements(arr: Column | str, k: int, *keys: Key) -> Column:
    """First ``k`` elements of each row's array under ``keys`` (fewer if the
    array is shorter). Row-local: no shuffle, the parent row stays in place."""
    return F.slice(sort_elements(arr, *keys), 1, k)
