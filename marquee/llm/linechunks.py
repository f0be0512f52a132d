"""Line dedup by content-defined chunks.

A rolling hash over the hashes of neighbouring lines chooses the boundaries, so
the same lines are cut alike wherever they stand. Chunks of several lines that
occur again anywhere are removed but for their first occurrence, once their
bytes have been compared with it. A line as long as several is a chunk of its
own.

All of it is DataFrame expressions. What is grouped by a chunk's hash is
pre-aggregated; a hot chunk's occurrences meet its one kept text in a join that
Spark can split, and a text meets its own removals only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One line in so many is a candidate for a boundary, as measured over two lines.
ONE_IN = 2
#: Lines that a removable chunk has at least, and its words; words from which a
#: line is a chunk of its own and removable alone.
MIN_LINES, MIN_WORDS, LONG_LINE = 2, 10, 25
#: Words from which a line next to a blank one is compared together with that.
BESIDE_BLANK = 10


def words_of(text: Column) -> Column:
    """Runs of characters other than blanks and tabs, near enough: one more
    than the blanks."""
    return F.when(F.trim(text) == "", 0).otherwise(F.length(F.trim(text)) - F.length(F.replace(F.trim(text), F.lit(" "), F.lit(""))) + 1)


def _rotated(h: Column) -> Column:
    return F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))


def line_chunks(text: Column) -> Column:
    """The chunks of a text, in order: array of ``text, lines, words``; joined
    by line breaks they are the text. Null gives null.

    A boundary follows a line if the rolling hash (rotate and exclusive-or) of it
    and the line before is even by ``ONE_IN`` and that of the lines one up is
    not, so that chunks have two lines or more; long lines have boundaries on
    both sides."""
    lines = F.split(text, "\n")

    def per_text(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), (words_of(x) >= LONG_LINE).alias("long")))

        def cuts(hs: Column) -> Column:
            def pair(i: Column) -> Column:
                return F.pmod(_rotated(F.coalesce(F.get(hs, i - 1)["h"], F.lit(0))).bitwiseXOR(F.get(hs, i)["h"]), F.lit(ONE_IN)) == 0

            def ends(x: Column, i: Column) -> Column:
                after = F.coalesce(F.get(hs, i + 1)["long"], F.lit(True))
                return x["long"] | after | (pair(i) & (i > 0) & ~pair(i - 1))

            marks = F.transform(hs, lambda x, i: F.when(ends(x, i), i + 1))
            return F.filter(marks, lambda m: m.isNotNull())

        def parts(ends: Column) -> Column:
            def part(end: Column, i: Column) -> Column:
                begin = F.coalesce(F.get(ends, i - 1), F.lit(0))
                return F.struct(F.array_join(F.slice(lines, begin + 1, end - begin), "\n").alias("text"), (end - begin).alias("lines"))

            return F.transform(ends, part)

        return F.transform(_let(_let(hashes, cuts), parts), lambda c: F.struct(c["text"].alias("text"), c["lines"].alias("lines"), words_of(c["text"]).alias("words")))

    return _let(lines, per_text)


def _let(value: Column, use) -> Column:
    """``use(value)``, computing ``value`` once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def removable(chunk: Column) -> Column:
    return ((chunk["lines"] >= MIN_LINES) & (chunk["words"] >= MIN_WORDS)) | (chunk["words"] >= LONG_LINE)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks removed from the text, and all its other
    columns; adds ``lines_removed`` and ``chunks_removed`` (long).

    A chunk's first occurrence, which stays, is the one with the smallest id,
    then by a hash of the text, then by place. Texts that lose all their chunks
    are empty; null texts stay null. Null ids come first. Rows equal in id and
    text are one document and keep the same chunks. An empty table stays empty.
    Columns of ``docs`` with the names of those added are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lines_removed", "chunks_removed")]
    base = docs.select(*(F.col(f"`{c}`") for c in kept))
    text, key = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`")
    row = F.xxhash64(key, text)
    each = base.where(text.isNotNull()).select(key.alias("id"), row.alias("row"), F.posexplode(line_chunks(text)).alias("k", "c")).where(removable(F.col("c")))
    each = each.select("id", "row", "k", F.xxhash64("c.text").alias("hash"), F.col("c.text").alias("text"))

    place = F.struct("id", "row", "k")
    firsts = each.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.min_by("text", place).alias("text")).where("n > 1").drop("n")
    again = each.select("id", "row", "k", "hash").join(firsts, "hash").where(~F.struct("id", "row", "k").eqNullSafe(F.col("first")))
    removals = again.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("k", "text")).alias("__again"))

    joined = base.withColumn("__key", row).join(removals, F.col("__key").eqNullSafe(F.col("__row")) & key.eqNullSafe(F.col("__id")), "left")

    def divided(chunks: Column) -> Column:
        known = F.map_from_entries(F.transform(F.array_distinct(F.col("__again")), lambda a: F.struct(a["k"], a["text"])))

        def by_map(found: Column) -> Column:
            def repeated(c: Column, i: Column) -> Column:
                return F.coalesce(F.try_element_at(found, i) == c["text"], F.lit(False))  # the bytes

            return F.struct(F.filter(chunks, lambda c, i: ~repeated(c, i)).alias("stay"), F.filter(chunks, repeated).alias("go"))

        return _let(known, by_map)

    has = F.col("__again").isNotNull()
    joined = joined.withColumn("__parts", F.when(has, _let(line_chunks(text), divided)))
    new_text = F.when(has, F.array_join(F.transform("__parts.stay", lambda c: c["text"]), "\n")).otherwise(F.col(f"`{text_col}`"))
    lines = F.aggregate("__parts.go", F.lit(0).cast("long"), lambda a, c: a + c["lines"])
    return joined.select(*(new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept), F.coalesce(lines, F.lit(0)).cast("long").alias("lines_removed"), F.coalesce(F.size("__parts.go"), F.lit(0)).cast("long").alias("chunks_removed"))


def passages(text: Column) -> Column:
    """The places of a text that are compared by ``dedup_passages``: array of
    ``k, n, hash``, for the ``n`` lines from line ``k`` on. These are each two
    neighbours among the lines with words (and the blank lines between them),
    each long line, and each line of ``BESIDE_BLANK`` words with a blank one
    before or after it."""
    lines = F.split(text, "\n")

    def per_text(lines: Column) -> Column:
        def per_words(words: Column) -> Column:
            def pairs(at: Column) -> Column:
                return F.transform(at, lambda k, i: F.struct(k.alias("k"), (F.get(at, i + 1) - k + 1).alias("n")))

            def beside(x: Column, i: Column) -> Column:
                after = F.get(words, i + 1)
                return ((x == 0) != (after == 0)) & (x + after >= BESIDE_BLANK)

            worded = F.filter(F.transform(words, lambda x, i: F.when(x > 0, i)), lambda k: k.isNotNull())
            long = F.transform(words, lambda x, i: F.struct(i.alias("k"), F.when(x >= LONG_LINE, 1).alias("n")))
            edges = F.transform(words, lambda x, i: F.struct(i.alias("k"), F.when(beside(x, i), 2).alias("n")))
            return F.filter(F.concat(_let(worded, pairs), long, edges), lambda s: s["n"].isNotNull())

        spans = _let(F.transform(lines, words_of), per_words)
        return F.transform(spans, lambda s: F.struct(s["k"].alias("k"), s["n"].alias("n"), F.xxhash64(_lines_at(lines, s)).alias("hash")))

    return _let(lines, per_text)


def _lines_at(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["k"] + 1, span["n"]), "\n")


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", copies_alike: bool = False) -> DataFrame:
    """Like ``dedup_lines``, but finds repeated passages of two lines with words
    or more wherever they begin and end: every two neighbouring lines that stand
    elsewhere before go, so a passage of n lines loses all n in each later copy.

    The first occurrence, which stays, is chosen as in ``dedup_lines``; the first
    occurrence of a line always stays. Of a line that follows itself one stays.
    ``chunks_removed`` counts the runs of lines removed.

    With ``copies_alike`` equal texts are one document whatever their ids: they
    are no repeats of each other, lose the same lines and stay equal. The
    occurrence that stays is then the one in the text with the smallest hash.

    Only hashes and places are grouped over all lines; the bytes of the first
    occurrence are read again for passages that do repeat.
    """
    kept = [c for c in docs.columns if c not in ("lines_removed", "chunks_removed")]
    base = docs.select(*(F.col(f"`{c}`") for c in kept))
    text = F.col(f"`{text_col}`").cast("string")
    key = F.lit(None).cast("long") if copies_alike else F.col(f"`{id_col}`")
    row = F.xxhash64(key, text)
    each = base.where(text.isNotNull()).select(key.alias("id"), row.alias("row"), F.explode(passages(text)).alias("s")).select("id", "row", "s.k", "s.n", "s.hash")

    place = F.struct("id", "row", "k", "n")
    firsts = each.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last") if copies_alike else each.groupBy("hash").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1")
    wanted = firsts.groupBy(F.col("first.id").alias("__id"), F.col("first.row").alias("__row")).agg(F.collect_list(F.struct("hash", F.col("first.k").alias("k"), F.col("first.n").alias("n"))).alias("__wanted"))

    def same_row(rows: DataFrame, how: str) -> DataFrame:
        return base.withColumn("__key", row).join(rows, F.col("__key").eqNullSafe(F.col("__row")) & key.eqNullSafe(F.col("__id")), how)

    lines = F.split(text, "\n")
    read = _let(lines, lambda ls: F.transform("__wanted", lambda s: F.struct(s["hash"].alias("hash"), s["k"].alias("k"), s["n"].alias("n"), _lines_at(ls, s).alias("text"))))
    known = same_row(wanted, "inner").select(F.col("__id").alias("id"), F.col("__row").alias("row"), F.explode(read).alias("s")).select("s.hash", F.struct("id", "row", "s.k", "s.n").alias("first"), "s.text")
    known = known.groupBy("hash", "first").agg(F.min("text").alias("text"))  # rows equal in id and text are one

    again = each.join(known, "hash").where(~place.eqNullSafe(F.col("first")))
    gather = F.collect_set if copies_alike else F.collect_list  # copies name the same places
    removals = again.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(gather(F.struct("k", "n", "text")).alias("__again"))

    def stay(ls: Column) -> Column:
        repeated = F.filter("__again", lambda a: _lines_at(ls, a) == a["text"])  # the bytes
        gone = F.flatten(F.transform(repeated, lambda a: F.sequence(a["k"], a["k"] + a["n"] - 1)))
        return F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone)

    def divided(ls: Column) -> Column:
        def by_place(at: Column) -> Column:
            before = F.transform(at, lambda k, i: (k > F.coalesce(F.get(at, i - 1), F.lit(-1)) + 1).cast("long"))
            runs = F.aggregate(before, F.lit(0).cast("long"), lambda a, x: a + x) + (F.size(ls) - 1 > F.coalesce(F.get(at, F.size(at) - 1), F.lit(-1))).cast("long")
            return F.struct(F.array_join(F.transform(at, lambda k: F.get(ls, k)), "\n").alias("text"), (F.size(ls) - F.size(at)).cast("long").alias("lines"), runs.alias("runs"))

        return _let(stay(ls), by_place)

    joined = same_row(removals, "left").withColumn("__parts", F.when(F.col("__again").isNotNull(), _let(lines, divided)))
    new_text = F.when(F.col("__again").isNotNull(), F.col("__parts.text")).otherwise(F.col(f"`{text_col}`"))
    return joined.select(*(new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept), F.coalesce("__parts.lines", F.lit(0).cast("long")).alias("lines_removed"), F.coalesce("__parts.runs", F.lit(0).cast("long")).alias("chunks_removed"))
