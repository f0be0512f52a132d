"""Near duplicates by min-max hashing.

A text is the set of its word shingles. Under each of a number of permutations
both the smallest and the largest value are kept, so half as many hash
evaluations give as many signature values; runs of them (bands) are bucket keys.

Texts with equal sets are one class from the start, and only classes go on.
Classes that share a bucket are linked in two exact steps:

1. every class of a bucket is compared with the bucket's leader, the class that
   shares most buckets with others (the original of a family of copies shares
   more with each copy than copies share among themselves);
2. in a bucket whose classes do not all hang on one hub by then, the ones
   outside the largest group are compared with all others in the bucket that
   belong to other groups, in blocks of bounded size.

So within every bucket each pair of classes is compared or already linked
through a hub: no link between two classes that share a bucket is lost, and a
bucket of thousands of copies costs one comparison for each. Links are decided
on the whole sets. Components of the links give the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import over_batches, stored, utf8
from marquee.llm.components import connected_components

#: Bands, and signature values in each: two texts at a similarity of 0.85 share
#: no band with a probability of 3e-7.
BANDS, BAND_VALUES = 32, 6
#: Rows, and bytes of sets, of one side of a block.
BLOCK_ROWS, BLOCK_BYTES = 1024, 32 << 20
SLICE = 4096

_rng = np.random.default_rng(20240607)
PERMUTATIONS = BANDS * BAND_VALUES // 2
MULTIPLY = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
BAND_MIX = _rng.integers(0, 1 << 63, (BANDS, BAND_VALUES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words.

    Words are runs without the six ASCII blanks, A-Z lower-cased; fewer words
    than ``size`` are one shingle; no words, no shingles."""
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - size + 1)
    out = np.full(n, len(words) if len(words) < size else size, dtype=np.uint64)
    for k in range(min(size, len(words))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return np.unique(out)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from the min-max signature."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for a in range(0, len(shingles), SLICE):
        v = shingles[a:a + SLICE, None] * MULTIPLY + ADD
        np.minimum(low, v.min(axis=0), out=low)
        np.maximum(high, v.max(axis=0), out=high)
    # a band takes the least and greatest values of different permutations, as
    # both of one permutation agree more often than chance has it
    signature = mixed(np.concatenate([low, np.roll(high, BANDS // 2)])).reshape(BAND_VALUES, BANDS).T
    return mixed((signature * BAND_MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, bands``; no digest without shingles or id."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, bands = [], [], []
        for i, text in zip(*(c.to_pylist() for c in b.columns)):
            s = shingle_set(text, size)
            n.append(len(s))
            digest.append(_digest(s) if len(s) and i is not None else None)
            bands.append(band_keys(s) if len(s) and i is not None else None)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    return over_batches(docs, run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``digest, shingles`` of the wanted classes, from the text of the row
    that stands for each (``wanted``: ``digest, id``)."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "found", "shingles"])

    texts = wanted.join(docs, wanted.id == docs.doc_id).select("digest", "text")
    return over_batches(texts, run, "digest binary, found binary, shingles binary").where("digest = found").groupBy("digest").agg(F.first("shingles").alias("shingles"))


def _linked(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose whole sets are similar enough."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            p, q = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            fits = 100 * min(len(p), len(q)) >= percent * max(len(p), len(q))
            keep.append(fits and bool(_linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent)))
        return b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("digest").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("digest").alias("v"), F.col("shingles").alias("sv"))
    return over_batches(pairs.join(left, "u").join(right, "v").select("u", "v", "su", "sv"), run, "u binary, v binary")


def _shared_columns(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column of each shingle that occurs in more than one of the sets."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, cols, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    keep = several[cols]
    return rows[keep], number[cols[keep]], int(several.sum())


def _block_links(block: pa.Table, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links in one block between its rest rows and its members, where their
    groups differ."""
    rest, grp, digest = (block.column(c).to_pylist() for c in ("rest", "grp", "digest"))
    sets = [np.frombuffer(x, dtype=np.uint64) for x in block.column("shingles").to_pylist()]
    left = np.array([i for i, r in enumerate(rest) if r], dtype=int)
    right = np.array([i for i, r in enumerate(rest) if not r], dtype=int)
    if not len(left) or not len(right):
        return
    rows, cols, n = _shared_columns(sets)
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    inter = np.zeros((len(left), len(right)), dtype=np.float32)
    for a in range(0, n, SLICE):
        p, q = np.searchsorted(cols, [a, a + SLICE])
        dense = np.zeros((len(sets), min(SLICE, n - a)), dtype=np.float32)
        dense[rows[p:q], cols[p:q] - a] = 1
        inter += dense[left] @ dense[right].T
    size = np.array([len(s) for s in sets])
    number = {g: i for i, g in enumerate(set(grp))}
    group = np.array([number[g] for g in grp])
    inter = inter.astype(np.int64)
    ok = _linked(inter, size[left][:, None], size[right][None, :], percent) & (group[left][:, None] != group[right][None, :])
    for i, j in zip(*np.nonzero(ok)):
        yield digest[left[i]], digest[right[j]]


def _rest_links(members: DataFrame, hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 2: links of classes outside their bucket's largest group.

    ``members``: ``band, digest, n``; ``hubs``: ``digest, grp``."""
    m = members.where("n > 2").join(hubs, "digest", "left").select("band", "digest", F.coalesce("grp", "digest").alias("grp"))
    sizes = sets.select("digest", F.length("shingles").cast("long").alias("size"))
    m = m.join(sizes, "digest")
    groups = m.groupBy("band", "grp").agg(F.count("*").alias("k"), F.sum("size").alias("bytes"))
    most = F.max(F.struct("k", "grp", "bytes"))
    per_band = groups.groupBy("band").agg(most.alias("most"), F.sum("k").alias("n"), F.sum("bytes").alias("bytes")).where(F.col("n") > F.col("most.k"))

    def blocks(rows: Column, size: Column) -> Column:
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES)).cast("int")

    per_band = per_band.select("band", F.col("most.grp").alias("main"), blocks(F.col("n"), F.col("bytes")).alias("n_all"), blocks(F.col("n") - F.col("most.k"), F.col("bytes") - F.col("most.bytes")).alias("n_rest"))
    m = stored(m.join(per_band, "band").select("band", "digest", "grp", (F.col("grp") != F.col("main")).alias("out"), "n_all", "n_rest"), "minhash-rest")

    def of(n: str) -> Column:
        return F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    every = m.select("band", "digest", "grp", F.lit(False).alias("rest"), of("n_all").alias("i"), each("n_rest").alias("j"))
    rest = m.where("out").select("band", "digest", "grp", F.lit(True).alias("rest"), each("n_all").alias("i"), of("n_rest").alias("j"))
    rows = every.unionAll(rest).join(sets, "digest")

    def run(block: pa.Table) -> pa.Table:
        links = list(_block_links(block, percent))
        return pa.table({"u": pa.array([a for a, _ in links], pa.binary()), "v": pa.array([b for _, b in links], pa.binary())})

    return rows.groupBy("band", "i", "j").applyInArrow(run, "u binary, v binary").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts whose sets of ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` / 100 are linked; ``component_id`` is the smallest id
    reachable and ``kept`` tells whether it is the row's own. Null and empty
    texts have no shingles and stand alone. A null id cannot be linked: its
    component is null and it is kept. Rows that repeat an id are separate texts
    (equal ones are in one component and all kept, their id being the
    smallest); other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(_signed(docs, size), "minhash-rows")
    classes = stored(rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "minhash-classes")
    keys = classes.select("digest", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(keys.join(shared, "band").select("band", "digest", "n"), "minhash-members")

    sums = members.groupBy("digest").agg(F.sum("n").alias("weight"))
    sets = stored(_sets(docs, classes.select("digest", "id").join(sums, "digest", "left_semi"), size), "minhash-sets")
    lead = members.join(sums, "digest").groupBy("band").agg(F.max(F.struct("weight", "digest")).alias("top"))
    stars = members.join(lead, "band").where(F.col("digest") != F.col("top.digest")).groupBy("digest", F.col("top.digest").alias("v")).agg(F.max("top.weight").alias("weight"))
    stars = stored(stars.select(F.col("digest").alias("u"), "v", "weight"), "minhash-stars")
    links = stored(_confirmed(stars.select("u", "v"), sets, percent), "minhash-links")

    hub = links.join(stars, ["u", "v"]).groupBy("u").agg(F.max(F.struct("weight", "v")).alias("top")).select("u", F.col("top.v").alias("v"))
    upper = hub.select(F.col("u").alias("v"), F.col("v").alias("w"))
    hubs = hub.join(upper, "v", "left").select(F.col("u").alias("digest"), F.coalesce("w", "v").alias("grp"))
    more = _rest_links(members, hubs, sets, percent)

    roots = connected_components(links.unionAll(more))
    named = classes.select("digest", "id").join(roots.withColumnRenamed("node", "digest"), "digest")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    found = classes.select("digest", "id").join(named.select("digest", "root").join(least, "root").select("digest", "component_id"), "digest", "left").select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
