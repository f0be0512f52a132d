"""N-gram Jaccard join over a count-vector R-tree.

A text is the set of its word shingles. Hashing the shingles into groups and
counting them by group makes it a point: of two sets no more shingles can be
shared than the sum, over the groups, of the smaller of their two counts. The
points are packed into the leaves of an R-tree whose boxes hold the smallest and
largest count of each group; a pair of leaves whose largest counts already fall
short is never opened, a pair of points whose counts fall short is never
verified, and pairs that survive are decided on the whole sets.

The tree is entered by coordinates, not from the root, as a root would meet
every point of the corpus. Two linked sets of a size range differ in at most r
shingles. With the groups dealt into r + 1 + s blocks of coordinates they agree
in all counts of at least s + 1 blocks. So a point is entered under each of its
blocks (block number and the counts in it, as a hash), and only leaves that hold
points of one entry are opened against each other. Entries are ordered by how
many points they have; each point leaves out its s fullest ones, and of the s + 1
or more that two linked points share the emptiest is never left out by either.
That keeps entries made of passages that many texts share, and empty blocks, out
of the join without losing a pair.

Texts with equal sets are one class from the start. Points and sets meet in
sort-merge joins at every size, as both sides grow with the data. Nothing is capped: an entry
of any number of points falls into leaves of bounded size, opened pair by pair in
tasks of their own. Each opened pair gives back, for every class, how many
documents it links to, and a spanning forest of its links in place of all of
them; components of the forests are the components of all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import over_batches, stored, uncollected, utf8
from marquee.llm.components import connected_components

#: Groups of the coarse counts that boxes and bounds use.
GROUPS = 64
#: A leaf holds at most so many classes, and so many bytes of sets.
LEAF_ROWS, LEAF_BYTES = 1024, 4 << 20
#: Size ranges grow by this factor; the last bits of an entry's key name the range.
RANGE_GROWTH, RANGE_BITS = 1.5, 6
#: One block in so many of those that may differ is added for entries left out.
SPARE_ONE_IN = 8
SLICE = 4096
#: Leaves are opened as a whole where each point shares so many entries on average.
WHOLE_AT = 8
#: Classes that a task remembers, to give their entries once.
SEEN_CLASSES = 1 << 18
#: Bits of the filter that keeps texts without links from being shuffled: 2 MB.
FILTER_BITS = 1 << 24

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words.

    Words are runs without the six ASCII blanks, A-Z lower-cased; fewer words
    than ``size`` are one shingle; no words, no shingles."""
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    number: dict[bytes, int] = {}
    at = [number.setdefault(w, len(number)) for w in words]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))[at]
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = mixed(out * MIX + h[j:j + len(out)])
    return np.unique(out)


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Ranges:
    """Size ranges for links at ``percent``, with the blocks of each.

    Range k holds the sizes from ``starts[k]`` up to ``starts[k + 1]``. A link
    belongs to the range of its smaller set. ``blocks[k]`` is r + 1 + s and
    ``spare[k]`` is s; where r is 0 only equal sets are linked, and there are no
    blocks."""

    def __init__(self, percent: int) -> None:
        if not 1 <= percent <= 100:
            raise ValueError(f"percent must be between 1 and 100, not {percent}")
        self.percent = percent
        self.starts, self.blocks, self.spare = [1], [], []
        for _ in range(1 << RANGE_BITS):
            self.starts.append(ceil(self.starts[-1] * RANGE_GROWTH))
            smaller = self.starts[-1] - 1
            larger = smaller * 100 // percent
            differ = (100 - percent) * (smaller + larger) // (100 + percent)
            self.spare.append(max(1, (differ + 1) // SPARE_ONE_IN) if differ else 0)
            self.blocks.append(differ + 1 + self.spare[-1] if differ else 0)

    def of(self, n: int) -> list[int]:
        """The ranges that a set of ``n`` shingles can have links in."""
        least = -(-n * self.percent // 100)
        return [k for k in range(len(self.blocks)) if self.starts[k] <= n and self.starts[k + 1] > least and self.blocks[k]]

    def entries(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the blocks of a set, in each of its ranges: a hash of the
        block's number and of the groups counted in it, with the range below."""
        keys = []
        spot = mixed(shingles + np.uint64(1)) >> np.uint64(16)
        for k in self.of(len(shingles)):
            block = spot % np.uint64(self.blocks[k])
            order = np.argsort(block, kind="stable")
            found, first = np.unique(block[order], return_index=True)
            held = np.zeros(self.blocks[k], dtype=np.uint64)
            held[found] = np.add.reduceat(mixed(shingles[order] * MIX), first)
            held = mixed(held + np.arange(self.blocks[k], dtype=np.uint64) * MIX)
            keys.append((held >> np.uint64(RANGE_BITS) << np.uint64(RANGE_BITS)) | np.uint64(k))
        return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, dtype=np.int64)


def coarse_counts(shingles: np.ndarray) -> np.ndarray:
    """The point of a set: its shingles counted by ``GROUPS`` groups."""
    return np.bincount((shingles >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS).astype(np.int32)


def enough(shared, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def _signed(docs: DataFrame, size: int, ranges: Ranges) -> DataFrame:
    """``doc_id, n_shingles, digest, entries``; no digest without shingles or id.

    A task gives the entries of a class with the first of its copies that it
    meets, and leaves them null on the others, so a class of any number of copies
    sends its entries on once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        with uncollected():
            for b in batches:
                n, digest, entries = [], [], []
                for i, text in zip(*(c.to_pylist() for c in b.columns)):
                    s = shingle_set(text, size)
                    d = digest_of(s) if len(s) and i is not None else None
                    n.append(len(s))
                    digest.append(d)
                    entries.append(ranges.entries(s) if d is not None and d not in seen else None)
                    if len(seen) >= SEEN_CLASSES:
                        seen.clear()
                    seen.add(d)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(entries, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "entries"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, entries array<long>")


def class_key() -> Column:
    """Eight bytes that stand for a class among entries. Should two classes share
    them, they are entered together: more is compared, nothing is lost."""
    return F.xxhash64("digest")


def shared_entries(points: DataFrame, ranges: Ranges) -> DataFrame:
    """``entry, cls`` of the entries under which links can be found, from
    ``digest, entries`` of each class (more than once at will).

    A class is entered under a range's blocks only if at least s + 1 of them hold
    another class too, and then without its s fullest. All entries are shuffled
    once; what a single class holds goes no further."""
    spare = F.array(*[F.lit(s) for s in ranges.spare])
    rows = points.select(class_key().alias("cls"), F.explode("entries").alias("entry"))
    here = Window.partitionBy("entry")
    counted = rows.select("entry", "cls", F.count("*").over(here).alias("n"), F.min("cls").over(here).alias("low"), F.max("cls").over(here).alias("top"))
    shared = counted.where("low < top").groupBy("entry", "cls").agg(F.max("n").alias("n"))
    shared = shared.withColumn("k", F.col("entry").bitwiseAND((1 << RANGE_BITS) - 1).cast("int"))
    fullest = Window.partitionBy("cls", "k").orderBy(F.desc("n"), F.desc("entry"))
    kept = shared.withColumn("place", F.row_number().over(fullest)).where(F.col("place") > F.element_at(spare, F.col("k") + 1))
    kept = kept.select("entry", "cls", F.min("cls").over(here).alias("low"), F.max("cls").over(here).alias("top"), F.count("*").over(here).alias("n"))
    return kept.where("low < top").select("entry", "cls", "n")


def likely(docs: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``docs`` whose ``column`` may be an ``id`` of ``wanted``: all
    that are, and of the others those that a filter of ``FILTER_BITS`` bits lets
    through. It is broadcast, as its size is fixed; with more ids than it can tell
    apart more rows pass, and the join that follows decides."""
    def spot(c: str) -> Column:
        return F.xxhash64(c).bitwiseAND(FILTER_BITS - 1)

    words = wanted.select(spot("id").alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("bits"))
    spotted = docs.withColumn("spot", spot(column)).join(F.broadcast(words), F.shiftright("spot", 6) == F.col("word"))
    return spotted.where(F.expr("bits & shiftleft(1L, cast(spot & 63 as int)) != 0")).select(*docs.columns)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``digest, n, counts, shingles`` of the wanted classes, from the text of the
    row that stands for each (``wanted``: ``digest, id``); twice where a row is."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([digest_of(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                                           pa.array([coarse_counts(s) for s in sets], pa.list_(pa.int32())), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "found", "n", "counts", "shingles"])

    some = likely(docs, wanted, "doc_id")
    texts = wanted.join(some.hint("merge"), F.col("id") == F.col("doc_id")).select("digest", "text")
    return over_batches(texts, run, "digest binary, found binary, n long, counts array<int>, shingles binary").where("digest = found").drop("found")


def packed(points: DataFrame) -> DataFrame:
    """``digest, cls, copies, leaf``: the classes in leaves of bounded size, from
    ``digest, cls, copies, hub, n, bytes``. Points lie in the order of their
    fullest entry, then of size, so that families of copies fill leaves of their
    own. The order is cut into tasks by range; prefix sums of the tasks' rows and
    bytes number the leaves through, so they do not hang on the number of tasks. A
    leaf ends after ``LEAF_ROWS`` rows or with the row that fills ``LEAF_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = size = 0
        for b in batches:
            n = b.column("bytes").to_numpy()
            before = size + np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("digest", "cls", "copies", "task")), pa.array(np.arange(row, row + len(n))), pa.array(before), b.column("bytes")],
                                             ["digest", "cls", "copies", "task", "row", "before", "bytes"])
            row, size = row + len(n), size + int(n.sum())

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = points.repartitionByRange(parts, "hub", "n", "digest").sortWithinPartitions("hub", "n", "digest")
    ordered = ordered.select("digest", "cls", "copies", F.col("bytes").cast("long").alias("bytes"), F.spark_partition_id().alias("task"))
    laid = stored(ordered.mapInArrow(run, "digest binary, cls long, copies long, task int, row long, before long, bytes long"), "ngram-order")
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = laid.groupBy("task").agg(F.count("*").alias("rows"), F.sum("bytes").alias("size"))
    base = tasks.select("task", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("row0"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size0"))
    # as many rows as there are tasks; both numbers only grow along the order, so equal sums mean equal numbers
    leaf = F.floor((F.col("row") + F.col("row0")) / LEAF_ROWS) + F.floor((F.col("before") + F.col("size0")) / LEAF_BYTES)
    return laid.join(F.broadcast(base), "task").select("digest", "cls", "copies", leaf.cast("long").alias("leaf"))


def opened(members: DataFrame, leaves: DataFrame, boxes: DataFrame, percent: int) -> DataFrame:
    """``a, b, digest, leaf, copies``: pairs of leaves to open, a <= b, each with
    the points of either that share an entry with the other.

    ``members``: ``entry, cls``; ``leaves`` as :func:`packed` gives them;
    ``boxes``: ``leaf, high, least`` (the largest count of each group and the
    smallest set). Leaves meet by entry, as one row for all of their points
    there. Two leaves whose summed largest counts could not link their smallest
    sets stay closed. Where the points that share entries, counted by entry, are
    ``WHOLE_AT`` times as many as the leaves hold, nearly all of them do, and the
    leaves are opened as a whole: a pair of leaves costs a bounded number of rows,
    however many entries its points share."""
    placed = members.select("entry", "cls").join(leaves.select("cls", "digest", "leaf"), "cls")
    held = stored(placed.groupBy("entry", "leaf").agg(F.collect_list("digest").alias("held")), "ngram-held")
    own = held.where(F.size("held") > 1).select(F.col("leaf").alias("a"), F.col("leaf").alias("b"), "held")
    one = held.select("entry", F.col("leaf").alias("a"), F.col("held").alias("held_a"))
    two = held.select("entry", F.col("leaf").alias("b"), F.col("held").alias("held_b"))
    across = one.join(two, "entry").where("a < b").select("a", "b", F.concat("held_a", "held_b").alias("held"))
    met = stored(own.unionByName(across), "ngram-met")

    size = leaves.groupBy("leaf").agg(F.count("*").alias("size"))
    pairs = met.groupBy("a", "b").agg(F.sum(F.size("held")).alias("k"))
    low = boxes.join(size, "leaf").select(F.col("leaf").alias("a"), F.col("high").alias("high_a"), F.col("least").alias("least_a"), F.col("size").alias("size_a"))
    top = boxes.join(size, "leaf").select(F.col("leaf").alias("b"), F.col("high").alias("high_b"), F.col("least").alias("least_b"), F.col("size").alias("size_b"))
    bound = F.aggregate(F.zip_with("high_a", "high_b", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    open_ = pairs.join(low, "a").join(top, "b").where((F.col("a") == F.col("b")) | ((100 + percent) * bound >= percent * (F.col("least_a") + F.col("least_b"))))
    both = F.col("size_a") + F.when(F.col("a") == F.col("b"), 0).otherwise(F.col("size_b"))
    open_ = stored(open_.select("a", "b", (F.col("k") >= WHOLE_AT * both).alias("whole")), "ngram-open")

    part = met.join(open_.where("not whole").select("a", "b"), ["a", "b"]).select("a", "b", F.explode("held").alias("digest")).distinct()
    part = part.join(leaves.select("digest", "leaf", "copies"), "digest")
    sides = open_.where("whole").select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("leaf"))
    whole = sides.join(leaves.select("leaf", "digest", "copies"), "leaf")
    return part.select("a", "b", "digest", "leaf", "copies").unionByName(whole.select("a", "b", "digest", "leaf", "copies"))


def _shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each left and each right set share."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, cols, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    keep = several[cols]
    rows, cols, n = rows[keep], number[cols[keep]], int(several.sum())
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    shared = np.zeros((len(left), len(right)), dtype=np.float64)
    for a in range(0, n, SLICE):
        p, q = np.searchsorted(cols, [a, a + SLICE])
        dense = np.zeros((len(sets), min(SLICE, n - a)), dtype=np.float32)
        dense[rows[p:q], cols[p:q] - a] = 1
        shared += dense[left] @ dense[right].T
    return shared.astype(np.int64)


def near_points(left: list[dict], right: list[dict] | None, percent: int) -> np.ndarray:
    """Which points of two leaves, or of one (``right`` None), may be linked: the
    summed smaller counts of their groups would do for their sizes."""
    rows = left + (right or [])
    n = np.array([r["n"] for r in rows], dtype=np.int64)
    counts = np.array([r["counts"] for r in rows], dtype=np.int32).reshape(len(rows), -1)
    here = np.arange(len(left))
    there = here if right is None else np.arange(len(left), len(rows))
    bound = np.zeros((len(here), len(there)), dtype=np.int64)
    for g in range(counts.shape[1]):
        bound += np.minimum(counts[here, g][:, None], counts[there, g][None, :])
    near = enough(bound, n[here][:, None], n[there][None, :], percent)
    if right is None:
        np.fill_diagonal(near, False)
    return near


def open_pair(left: list[dict], right: list[dict] | None, percent: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, bytes]]]:
    """Links between two leaves, or within one (``right`` None).

    Gives for each linked class the number of documents it links to there, and a
    spanning forest of the links. A point is a row of ``digest, n, counts,
    shingles, copies``."""
    rows = left + (right or [])
    here = np.arange(len(left))
    there = here if right is None else np.arange(len(left), len(rows))
    near = near_points(left, right, percent)
    i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(i):
        return [], []
    n = np.array([r["n"] for r in rows], dtype=np.int64)
    used = np.unique(np.concatenate([here[i], there[j]]))
    sets = [np.frombuffer(rows[k]["shingles"], dtype=np.uint64) for k in used]
    shared = _shared_counts(sets, np.searchsorted(used, here[i]), np.searchsorted(used, there[j]))
    linked = near[np.ix_(i, j)] & enough(shared, n[here[i]][:, None], n[there[j]][None, :], percent)

    copies = np.array([r["copies"] for r in rows], dtype=np.int64)
    sums = np.zeros(len(rows), dtype=np.int64)
    sums[here[i]] += linked @ copies[there[j]]
    if right is not None:
        sums[there[j]] += copies[here[i]] @ linked
    whole = np.zeros((len(rows), len(rows)), dtype=bool)
    whole[np.ix_(here[i], there[j])] = linked
    whole |= whole.T
    forest, seen = [], np.zeros(len(rows), dtype=bool)
    for start in np.flatnonzero(whole.any(axis=1)):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            x = todo.pop()
            new = np.flatnonzero(whole[x] & ~seen)
            seen[new] = True
            forest += [(rows[x]["digest"], rows[y]["digest"]) for y in new]
            todo += new.tolist()
    return [(rows[k]["digest"], int(sums[k])) for k in np.flatnonzero(sums)], forest


def over_leaf_pairs(points: DataFrame, fn: Callable[[list[dict], list[dict] | None], Iterable[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """``fn`` on the points of each pair of leaves ``a, b``: those of leaf a, and
    those of leaf b or None where the two are one. A task holds one pair at a
    time, which is at most two leaves."""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def results(rows: list[dict]) -> Iterable[tuple]:
        a, b = rows[0]["a"], rows[0]["b"]
        rows = list({r["digest"]: r for r in rows}.values())
        left = [r for r in rows if r["leaf"] == a]
        return fn(left, None if a == b else [r for r in rows if r["leaf"] != a])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(types), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair: list[dict] = []
        with uncollected():
            for b in batches:
                out: list[tuple] = []
                for at in range(0, b.num_rows, SLICE // 8):
                    for r in b.slice(at, SLICE // 8).to_pylist():
                        if pair and (pair[0]["a"], pair[0]["b"]) != (r["a"], r["b"]):
                            out += results(pair)
                            pair = []
                        pair.append(r)
                yield batch(out)
            if pair:
                yield batch(list(results(pair)))

    return points.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(run, schema)


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose points pass the bound with another point of
    their pair; only their sets are sent on to be verified."""

    def survivors(left: list[dict], right: list[dict] | None) -> Iterator[tuple]:
        near = near_points(left, right, percent)
        sides = [(left, near.any(axis=1))] + ([(right, near.any(axis=0))] if right is not None else [])
        for rows, found in sides:
            yield from ((r["a"], r["b"], r["digest"], r["leaf"], r["copies"]) for r, ok in zip(rows, found) if ok)

    points = pairs.join(sets.select("digest", "n", "counts").hint("merge"), "digest")
    return over_leaf_pairs(points, survivors, "a long, b long, digest binary, leaf long, copies long", [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()])


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``u, v, n``: a link of the forests, or with v null the documents that u
    links to in one pair of leaves. ``pairs`` as :func:`opened` gives them;
    ``sets``: ``digest, n, counts, shingles``."""

    def links(left: list[dict], right: list[dict] | None) -> Iterator[tuple]:
        sums, forest = open_pair(left, right, percent)
        yield from ((u, None, n) for u, n in sums)
        yield from ((u, v, 0) for u, v in forest)

    return over_leaf_pairs(pairs.join(sets.hint("merge"), "digest"), links, "u binary, v binary, n long", [pa.binary(), pa.binary(), pa.int64()])


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row.

    Two texts are linked when their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100. ``n_links`` counts the documents
    that a row is linked to, its copies included; ``component_id`` is the smallest
    id reachable by links, the row's own included. Null and empty texts have no
    shingles and no links. A null id cannot be linked: its component is null. Rows
    that repeat an id are separate texts; other columns are not read; an empty
    table gives no rows. No pair of texts is lost, and none is compared twice.
    """
    ranges = Ranges(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(_signed(docs, size, ranges), "ngram-rows")
    classes = stored(rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "ngram-classes")

    members = stored(shared_entries(rows.where(F.size("entries") > 0).select("digest", "entries"), ranges), "ngram-members")
    hubs = members.groupBy("cls").agg(F.max(F.struct("n", "entry")).alias("hub")).select("cls", F.col("hub.entry").alias("hub"))
    active = stored(classes.withColumn("cls", class_key()).join(hubs, "cls"), "ngram-active")

    sets = stored(_sets(docs, active.select("digest", "id"), size), "ngram-sets")
    sizes = sets.select("digest", "n", F.length("shingles").alias("bytes")).distinct()
    leaves = stored(packed(active.join(sizes, "digest").select("digest", "cls", "copies", "hub", "n", "bytes")), "ngram-leaves")
    counted = sets.select("digest", "n", "counts").join(leaves.select("digest", "leaf"), "digest")
    boxes = counted.groupBy("leaf").agg(F.array(*[F.max(F.col("counts")[g]) for g in range(GROUPS)]).alias("high"), F.min("n").alias("least"))
    near = stored(_near(opened(members, leaves, boxes, percent), sets, percent), "ngram-near")
    found = stored(_links(near, sets, percent), "ngram-links")

    roots = connected_components(found.where("v is not null").select("u", "v"))
    linked = found.where("v is null").groupBy(F.col("u").alias("digest")).agg(F.sum("n").alias("linked"))
    named = roots.withColumnRenamed("node", "digest").join(classes.select("digest", "id"), "digest")
    least = named.groupBy("root").agg(F.min("id").alias("least"))
    reach = named.join(least, "root").select("digest", "least")
    result = classes.join(reach, "digest", "left").join(linked, "digest", "left").select(
        "digest", F.coalesce("least", "id").alias("component_id"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    result = stored(result, "ngram-result")
    out = rows.select("doc_id", "n_shingles", "digest").join(result, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
