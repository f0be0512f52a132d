"""URL rules by a sort-merge range join.

Hosts are written label by label from the top ("com.example.www."), so that a
host and its subdomains are one interval of keys and intervals of rules nest.
URLs and the ends of the rules' intervals are sorted together; a sweep keeps the
stack of the rules whose interval is open and takes, for each URL, the longest
one whose path the URL's path starts with.

The key space is cut at quantiles of the URLs' own keys, so that a host with a
third of all URLs falls into many tasks; a rule goes to each part that its
interval meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import unit_hash

#: URLs whose keys set the cuts, per part (a bounded sample drawn by hash).
SAMPLED = 30
DEFAULT = "allow"
#: Behind every key that begins with a reversed host.
LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null and without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Rows by part and key; of equal keys, intervals open first (outer ones
    before inner ones) and close where a key is past their end."""
    stack: list[tuple[str, str, str, str]] = []  # end, path, rule, verdict
    now = None
    for b in batches:
        out: list[tuple] = []
        for part, key, end, row, host, path, rule, verdict in zip(*(c.to_pylist() for c in b.columns)):
            if part != now:
                now, stack = part, []
            while stack and stack[-1][0] <= key:
                stack.pop()
            if end is not None:
                stack.append((end, path, rule, verdict))
                continue
            best = None
            for r in stack:
                if path.startswith(r[1]) and (best is None or len(r[2]) >= len(best[2])):
                    best = r
            out.append((row, host, path, best[2] if best else None, best[3] if best else default))
        if out:
            kinds = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["page_id", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules``: ``host, path, verdict``. A rule fits its host and all subdomains
    if the URL's path starts with its path; the longest rule (host and path
    together; of equally long ones the deeper host, then the later by path and
    verdict) gives the verdict, else ``default``; ``rule`` is its host and path.
    Null URLs and those without ``://`` have an empty host and path, which only
    a rule without a host fits; rules with a null column are left out. Null ids
    and repeated rows are judged like any other; other columns are not read.
    """
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).cast("long").alias("row"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("key", F.concat(host_key(F.col("host")), F.lit(" "), F.col("path"), F.lit(" "), F.coalesce(F.hex("row"), F.lit(""))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = urls.count()
    sample = sorted(r["key"] for r in urls.select("key", "row").where(unit_hash("key", "row") < min(1.0, SAMPLED * parts / max(n, 1))).select("key").collect())  # about SAMPLED keys per part
    cuts = sorted(set(sample[SAMPLED::SAMPLED]))

    def part_of(key: Column) -> Column:
        """Number of cuts at or before the key, by halving."""
        def within(a: int, b: int) -> Column:
            if a == b:
                return F.lit(a)
            m = (a + b) // 2
            return F.when(key >= F.lit(cuts[m]), within(m + 1, b)).otherwise(within(a, m))
        return within(0, len(cuts))

    low = host_key(F.lower("host"))
    spans = rules.where("host is not null and path is not null and verdict is not null").select(F.col("path"), F.concat("host", "path").alias("rule"), "verdict", low.alias("key"), F.concat(low, F.lit(LAST)).alias("end")).distinct()
    spans = spans.select(F.explode(F.sequence(part_of(F.col("key")), part_of(F.col("end")))).alias("part"), "key", "end", F.lit(None).cast("long").alias("row"), F.lit("").alias("host"), "path", "rule", "verdict")
    null = F.lit(None).cast("string")
    rows = urls.select(part_of(F.col("key")).alias("part"), "key", null.alias("end"), "row", "host", "path", null.alias("rule"), null.alias("verdict")).unionAll(spans)
    order = ["part", "key", F.desc_nulls_last("end"), "rule", "path", "verdict"]
    return rows.repartition(parts, "part").sortWithinPartitions(*order).mapInArrow(lambda b: _sweep(b, default), "page_id long, host string, path string, rule string, verdict string")
