"""Nest flat rows into documents and take documents apart again.

Every operator is a plain ``DataFrame -> DataFrame`` function. Grouping
operators (``collect_sorted``, ``embed_children``, ``lookup_array``,
``lookup_in_array``) cost one shuffle on the grouping key; Spark runs
``collect_list`` as a partial (map-side) plus final aggregate. Element order is
always fixed by an explicit sort inside the array, never by a prior sort,
which does not survive a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.arrays import Key, sort_elements
from marquee.operators.joins import left_join_salted


def nest(df: DataFrame, name: str, cols: Sequence[str], aliases: Sequence[str] | None = None) -> DataFrame:
    """Replace ``cols`` by one struct column ``name`` appended at the end."""
    aliases = aliases or cols
    fields = [F.col(c).alias(a) for c, a in zip(cols, aliases)]
    return df.withColumn(name, F.struct(*fields)).drop(*[c for c in cols if c != name])


def unwind(df: DataFrame, path: str, as_name: str | None = None, position: str | None = None) -> DataFrame:
    """One row per element of the array at ``path``; the element takes the
    array's place (or ``as_name``). Rows whose array is null or empty vanish.

    ``position`` also keeps the element's 0-based index. An element taken from
    inside a struct must not take another column's name: give ``as_name``.
    """
    target = as_name or path.split(".")[-1]
    if target in df.columns and target != path:
        raise ValueError(f"unwind({path!r}) would replace the column {target!r}; pass as_name")
    others = [F.col(c) for c in df.columns if c != target]
    if position:
        return df.select(*others, F.posexplode(path).alias(position, target))
    return df.select(*others, F.explode(path).alias(target))


def collect_sorted(
    df: DataFrame,
    key: str | Sequence[str],
    fields: Sequence[str | Column],
    name: str,
    order_by: Sequence[Key] | None = None,
) -> DataFrame:
    """Group by ``key`` and collect ``struct(fields)`` into a sorted array.

    Without ``order_by`` elements sort by their natural struct order (field by
    field, nulls first), else by the given keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    items = F.collect_list(F.struct(*fields))
    arr = sort_elements(items, *order_by) if order_by else F.sort_array(items)
    return df.groupBy(*keys).agg(arr.alias(name))


#: Rows drawn per part of a heavy key to choose where its parts begin, in expectation.
DRAWN_PER_PART = 64


def collect_sorted_in_parts(
    df: DataFrame, key: str, fields: Sequence[str | Column], name: str, slots: int = 64
) -> DataFrame:
    """:func:`collect_sorted` in natural struct order, where no task sorts all
    elements of a key that holds a large share of the rows.

    A key (null included) with more than one in ``slots`` of the rows is heavy; a
    count with map-side partials finds them, and there are fewer than ``slots``.
    A heavy key's elements are dealt by value over as many parts as it has
    ``slots``-ths of the rows: a draw by a hash of the element, some
    ``DRAWN_PER_PART`` a part, gives the values where parts begin. Each
    (key, part) is sorted and collected on its own, and the document joins its
    few sorted parts end to end. The arrays equal those of ``collect_sorted``
    whatever the draw holds, as parts never overlap in value; the draw only
    evens out their sizes. Elements equal in all fields share a part.

    The lists that are broadcast are bounded by ``slots``: heavy keys, and fewer
    than three times ``slots`` begins in all. Other keys are collected as in
    ``collect_sorted``, with one shuffle. ``df`` is read once for the counts, once
    for the draw, and once each for heavy and other keys. Elements must be of a
    type that can be ordered (no maps).
    """
    rows = df.select(F.col(key), F.struct(*fields).alias("_item"))
    counts = rows.groupBy(F.col(key).alias("_hk")).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    heavy = counts.where(F.col("_n") * slots > total.scalar())
    heavy = heavy.select("_hk", "_n", F.ceil(F.col("_n") * slots / total.scalar()).cast("int").alias("_parts"))
    is_heavy = F.col(key).eqNullSafe(F.col("_hk"))

    drawn = rows.join(F.broadcast(heavy), is_heavy).where(F.pmod(F.xxhash64("_item"), "_n") < DRAWN_PER_PART * F.col("_parts"))
    drawn = drawn.groupBy("_hk", "_parts").agg(F.sort_array(F.collect_set("_item")).alias("_drawn"))
    begins = F.transform(
        F.sequence(F.lit(1), F.col("_parts") - 1),
        lambda i: F.get("_drawn", F.floor(i * F.size("_drawn") / F.col("_parts")).cast("int")),
    )
    begins = heavy.select("_hk").join(drawn.select(F.col("_hk").alias("_dk"), begins.alias("_begins")), F.col("_hk").eqNullSafe(F.col("_dk")), "left")

    dealt = rows.join(F.broadcast(begins.select("_hk", "_begins")), is_heavy)
    before = F.size(F.filter("_begins", lambda b: b <= F.col("_item")))
    dealt = dealt.select(key, "_item", F.when(F.col("_begins").isNull(), 0).otherwise(before).alias("_part"))
    parts = dealt.groupBy(key, "_part").agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    whole = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_part", "_items"))).alias("_all"))
    whole = whole.select(key, F.flatten(F.transform("_all", lambda p: p["_items"])).alias(name))

    others = rows.join(F.broadcast(heavy), is_heavy, "left_anti")
    return others.groupBy(key).agg(F.sort_array(F.collect_list("_item")).alias(name)).unionAll(whole)


def embed_children(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    fields: Sequence[str | Column],
    name: str,
    order_by: Sequence[Key] | None = None,
    only_parents: bool = False,
) -> DataFrame:
    """Attach each parent's children as an array column (left outer: parents
    without children get null). Children with a null parent key belong to no
    parent and are dropped before the shuffle, so they cannot pile up in the
    one partition that null hashes to.

    ``only_parents`` first semi-joins the children to the parent keys, so
    when ``parent`` is a selection only its children are grouped.
    """
    kids = child.filter(F.col(child_key).isNotNull())
    if only_parents:
        kids = kids.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")
    grouped = collect_sorted(kids, child_key, fields, name, order_by)
    return parent.join(grouped.withColumnRenamed(child_key, parent_key), parent_key, "left")


def lookup_array(
    df: DataFrame,
    key: str,
    id_list: str,
    dim: DataFrame,
    dim_key: str,
    fields: Sequence[str],
    name: str,
    sep: str = ",",
    trim: bool = True,
    salted: bool = False,
) -> DataFrame:
    """Resolve a delimited id list into an array of ``struct(dim_key, fields)``.

    Keeps the list's own order (via the element position), keeps ids that have
    no match in ``dim`` with null fields, and leaves rows whose list is null with
    a null array. An empty list is one element with the id ``''``. ``id_list`` is removed from the output.

    ``salted`` spreads an id that a large share of all lists name (``''`` or one
    known title) over many tasks (:func:`left_join_salted`).
    """
    ids = F.split(F.col(id_list), sep)
    exploded = df.select(key, F.posexplode(ids).alias("_pos", "_id"))
    if trim:
        exploded = exploded.withColumn("_id", F.trim("_id"))
    lookup = dim.select(F.col(dim_key).alias("_id"), *fields)
    joined = left_join_salted(exploded, lookup, "_id", [key, "_pos"]) if salted else exploded.join(lookup, "_id", "left")
    grouped = joined.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.col("_id").alias(dim_key), *fields))).alias("_items")
    )
    resolved = grouped.select(key, F.transform("_items", lambda x: x.dropFields("_pos")).alias(name))
    return df.drop(id_list).join(resolved, key, "left")


def invert_array(
    right: DataFrame,
    array_key_path: str,
    fields: Sequence[Column],
    key_name: str,
) -> DataFrame:
    """One row per (key inside ``right``'s array, ``right`` row): the inverted
    index of an array-of-keys column. Each key counts once per row."""
    return right.select(F.explode(F.array_distinct(F.col(array_key_path))).alias(key_name), *fields).filter(
        F.col(key_name).isNotNull()
    )


def attach_grouped(
    left: DataFrame,
    left_key: str,
    pairs: DataFrame,
    name: str,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Group ``pairs`` (``left_key``, an optional ``_src`` rank, fields) by
    key into a duplicate-free array sorted by (``_src``, ``order_by``, other
    fields), and attach it to ``left`` (left outer); no match gives ``[]``.

    Pairs of keys that ``left`` lacks are dropped before anything is gathered.
    ``collect_set`` drops duplicates already in the partial aggregate, so a
    pair repeated many times never piles up in one array.
    """
    pairs = pairs.join(left.select(left_key), left_key, "left_semi")
    if "_src" not in pairs.columns:
        pairs = pairs.withColumn("_src", F.lit(0))
    field_names = [c for c in pairs.columns if c not in (left_key, "_src")]
    ordered = ["_src", *(order_by or field_names)]
    rest = [c for c in field_names if c not in ordered]
    grouped = pairs.groupBy(left_key).agg(
        F.sort_array(F.collect_set(F.struct(*ordered, *rest))).alias("_items")
    )
    grouped = grouped.select(
        left_key,
        F.transform("_items", lambda x: F.struct(*[x[f].alias(f) for f in field_names])).alias(name),
    )
    joined = left.join(grouped, left_key, "left")
    empty = F.array().cast(joined.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(F.col(name), empty))


def lookup_in_array(
    left: DataFrame,
    left_key: str,
    sources: Sequence[tuple[DataFrame, str, Sequence[Column]]],
    name: str,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """For each ``left`` row, all rows of each source whose array at the given
    path contains ``left_key``, as one array (sources concatenated in order,
    each source row once).

    Decorrelated as inverted index + equi join: every source is exploded on its
    key array, the pieces are unioned with their source rank, grouped by key
    (one shuffle), and joined back. Rows with no match get an empty array.
    """
    pieces = [
        invert_array(src, path, [F.lit(rank).alias("_src"), *fields], left_key)
        for rank, (src, path, fields) in enumerate(sources)
    ]
    union = pieces[0]
    for p in pieces[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return attach_grouped(left, left_key, union, name, order_by)
