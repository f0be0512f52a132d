"""Filter interaction audit by decision diagrams.

Every document fails a set of filters, its failure mask. Spark counts documents
by part and mask; a part then has at most 2^d masks for d filters, whatever its
size. From them a count-weighted decision diagram is built for each part: one
level per filter, a low branch for documents that pass it and a high branch for
those that fail, and on every node the counts of all documents below. The
diagram of the next order of filters comes from the last one by swapping two
adjacent levels, so one walk of swaps goes through all orders. In each order the
path of low branches from the root is the list of steps: what hangs on the high
branch of its k-th node is what the k-th filter removes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import over_batches

#: Counts that a node carries: documents, good ones, toxic ones.
Weight = tuple[int, int, int]
ZERO: Weight = (0, 0, 0)

#: Runs of the six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Node(NamedTuple):
    """A node of a diagram; ``low`` and ``high`` are None where it is a leaf."""

    weight: Weight
    low: Node | None
    high: Node | None


def _sum(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def _joined(low: Node, high: Node) -> Node:
    return Node(_sum(low.weight, high.weight), low, high)


def empty(levels: int) -> Node:
    """The diagram of no documents; all of its branches are shared."""
    node = Node(ZERO, None, None)
    for _ in range(levels):
        node = Node(ZERO, node, node)
    return node


def build(counts: dict[int, Weight], levels: Sequence[int]) -> Node:
    """The diagram of ``counts`` by failure mask; level k tests bit ``levels[k]``."""
    if not counts:
        return empty(len(levels))
    if not levels:
        return Node(counts[next(iter(counts))], None, None)
    bit = 1 << levels[0]
    return _joined(build({m: w for m, w in counts.items() if not m & bit}, levels[1:]),
                   build({m: w for m, w in counts.items() if m & bit}, levels[1:]))


def swapped(node: Node, depth: int) -> Node:
    """The same function with the levels ``depth`` and ``depth + 1`` exchanged.

    Only nodes of those two levels are new: the four branches below them change
    places, and everything under these stays as it is."""
    if depth:
        return node._replace(low=swapped(node.low, depth - 1), high=swapped(node.high, depth - 1))
    return Node(node.weight, _joined(node.low.low, node.high.low), _joined(node.low.high, node.high.high))


def swap_walk(n: int) -> list[int]:
    """Places of adjacent swaps that lead through all orders of ``n`` things,
    each met once: the last thing moves through the others from end to end,
    between one swap of the others and the next."""
    if n < 2:
        return []
    down, up = list(range(n - 2, -1, -1)), list(range(n - 1))
    places, at_front = list(down), True
    for place in swap_walk(n - 1):
        places.append(place + at_front)
        places += up if at_front else down
        at_front = not at_front
    return places


def all_orders(counts: dict[int, Weight], n: int) -> Iterator[tuple[tuple[int, ...], list[tuple[Weight, Weight]]]]:
    """Every order of ``n`` filters with its steps: (kept, removed) weights."""
    order = list(range(n))
    root = build(counts, order)
    for place in [None, *swap_walk(n)]:
        if place is not None:
            order[place], order[place + 1] = order[place + 1], order[place]
            root = swapped(root, place)
        steps, node = [], root
        while node.low is not None:
            steps.append((node.low.weight, node.high.weight))
            node = node.low
        yield tuple(order), steps


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def steps_of_orders(masks: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step, from rows ``part, mask, n, good, toxic``
    (one per part and failure mask; bit k of a mask is filter ``letters[k]``).

    Every part is one row of at most 2^d counts, so a part of any size costs the
    same, and parts are dealt over the tasks. A part without documents has no
    row; all counts are exact."""
    packed = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def part_rows(part: str, counts: dict[int, Weight]) -> Iterator[tuple]:
        fails = [sum(w[0] for m, w in counts.items() if m >> f & 1) for f in range(len(letters))]
        alone = [counts.get(1 << f, ZERO)[0] for f in range(len(letters))]
        walk = list(all_orders(counts, len(letters)))
        shapley = [0] * len(letters)
        for order, steps in walk:
            for f, (_, removed) in zip(order, steps):
                shapley[f] += removed[0]
        for order, steps in walk:
            name = "".join(letters[f] for f in order)
            for k, (f, (kept, removed)) in enumerate(zip(order, steps), 1):
                yield part, name, k, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], shapley[f]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [r for part, counts in zip(*(c.to_pylist() for c in b.columns))
                for r in part_rows(part, {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts})]
        names = [f.split(" ") for f in STEPS.split(", ")]
        types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows), names)], [n for n, _ in names])

    return over_batches(packed, run, STEPS)


def failures(text: Column) -> Column:
    """Bits 0 to 3 of the failure mask, from the text alone: A under 50 words;
    B under 65 % distinct words; C over 5 % capitals; D a symbol. Null counts as
    an empty text, which fails A only."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(whole) - F.length(F.translate(whole, UPPER, ""))
    tests = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(whole), whole.rlike(r"[#$%&*|]")]
    return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))


#: The filters, in the order of their bits; E is bit 4.
FILTERS = "ABCDE"


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents counted by part and failed filters.

    Filter E fails a document whose text, byte by byte as far as SHA-256 tells
    texts apart, belongs to a smaller id anywhere in the table. A null id is not
    smaller than any and has no smaller one; rows that repeat an id and a text
    count each and do not make each other fail. A null part is ''. A document is
    good (toxic) where any label row of its id has quality (toxic) 1.

    Rows are counted before they are shuffled, and the first id of a text meets
    its rows by (text, id), so a text, an id or a part with any share of all rows
    is spread over the tasks."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).cast("string").alias("text"))
    keyed = rows.select("doc_id", "part", failures(F.col("text")).alias("mask"),
                        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    counted = keyed.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    first = counted.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    met = counted.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    repeat = F.col("doc_id").isNotNull() & F.col("first").isNull()
    by_id = met.groupBy("doc_id", "part", (F.col("mask") + F.when(repeat, 16).otherwise(0)).alias("mask")).agg(F.sum("n").alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    marked = by_id.join(marks, "doc_id", "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """What each of the five filters does in each of their 120 orders, by part.

    Columns are those of ``STEPS``: documents kept after the step and removed by
    it, documents failing its filter that an earlier step removed, documents
    failing its filter only, good and toxic documents removed, and the filter's
    removals summed over all orders. Other columns of ``docs`` are not read; an
    empty table gives no rows. Edge cases are those of :func:`failure_masks`."""
    return steps_of_orders(failure_masks(docs, labels, id_col, text_col, part_col), FILTERS)
