"""Chat formatting from event logs.

A conversation is a log of events, folded per conversation in order of their
sequence number:

* ``message`` starts a turn with a role and a whole text;
* ``delta`` adds to the turn's text (streamed output);
* ``edit`` replaces the turn's text and takes back all later turns so far;
* ``regenerate`` empties the turn, whose text streams anew, and takes back all
  later turns so far.

Then each turn is rendered between markers, with all control strings in roles
and texts escaped reversibly, and the assistant's texts are the loss mask.

Everything is DataFrame expressions. Events of a turn are folded before turns
meet, and what a later reset takes back is found by a running maximum over
turns, so the log itself is never gathered; the finished conversation is, as it
is one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The markers of a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escaped(text: Column) -> Column:
    """Without any ``<|``: ``&`` becomes ``&amp;`` and ``<|`` ``&lt;|``."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    """Also without line breaks, as one ends the role."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("&nl;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def events_of_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A table of finished messages as a log: one ``message`` per row, in order
    of turn. Rows that repeat a turn are turns of their own, in order of role
    and text, nulls first."""
    log = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("at"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = Window.partitionBy("conv_id", "at").orderBy("role", "text")
    sub = F.row_number().over(order).cast("long")
    return log.select("conv_id", F.struct(F.col("at"), sub.alias("n")).alias("seq"), F.struct(F.col("at"), sub.alias("n")).alias("turn"), F.lit(MESSAGE).alias("kind"), "role", "text")


def fold_events(log: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``: the turns that stand at the end of the log.

    ``log``: ``conv_id, seq, turn, kind, role, text``; ``seq`` orders a
    conversation's events, ``turn`` its messages. Null texts are empty, a null
    role is empty, a turn has the last role given for it; events of unknown or
    null kind are left out. Deltas without a message make a turn. Null
    conversations are one conversation. Events with equal numbers keep no
    promised order.
    """
    log = log.where(F.col("kind").isin(MESSAGE, DELTA, EDIT, REGENERATE)).withColumn("text", F.when(F.col("kind") == REGENERATE, "").otherwise(F.coalesce("text", F.lit(""))))
    resets = F.col("kind").isin(EDIT, REGENERATE)
    starts = F.max(F.when(F.col("kind") != DELTA, F.col("seq")))
    per_turn = log.groupBy("conv_id", "turn").agg(F.max(F.when(resets, F.col("seq"))).alias("reset"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    taken = per_turn.select("conv_id", "turn", F.max("reset").over(before).alias("taken"))
    live = log.join(taken.withColumnRenamed("conv_id", "c").withColumnRenamed("turn", "t"), F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))).where("taken is null or seq > taken").drop("c", "t", "taken")
    turns = live.groupBy("conv_id", "turn").agg(starts.alias("start"), F.sort_array(F.collect_list(F.struct("seq", "role", "text"))).alias("events"))
    said = F.filter("events", lambda e: F.col("start").isNull() | (e["seq"] >= F.col("start")))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return turns.select("conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(F.transform(said, lambda e: e["text"]), "").alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: each conversation as one text, and the
    loss mask as ``start`` and ``end`` of each assistant text in it, in code
    points."""
    mark = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    parts = turns.select("conv_id", "turn", "role", mark.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(CLOSE) + 1)
    so_far = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(so_far), F.lit(0)) + F.length("head"))
    whole = F.concat("head", "body", F.lit(CLOSE + "\n"))
    # the turns' texts meet here, once
    gathered = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", whole.alias("whole"), F.when(F.col("role") == LEARNED_ROLE, F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end"))).alias("loss")))).alias("t"))
    return gathered.select("conv_id", F.array_join(F.transform("t", lambda t: t["whole"]), "").alias("formatted"), F.filter(F.transform("t", lambda t: t["loss"]), lambda m: m.isNotNull()).alias("loss"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: array of ``role, text, start, end`` in
    order; roles and texts unescaped, ``start`` and ``end`` those of the escaped
    text within its own turn."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(p: Column) -> Column:
        head = F.instr(p, "\n")
        tail = F.length(p) - F.lit(len(CLOSE) + 1)
        return F.struct(unescaped_role(F.substring(p, F.lit(1), head - 1)).alias("role"), unescaped(F.substring(p, head + 1, tail - head)).alias("text"), (head + F.lit(len(OPEN))).cast("long").alias("start"), (tail + F.lit(len(OPEN))).cast("long").alias("end"), (F.length(p) + F.lit(len(OPEN))).cast("long").alias("size"))

    return F.transform(pieces, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``, from the formatted text and its loss mask alone.

    A turn is under the mask if one of the mask's spans is its text: the spans
    are in order, so each is met with the turn at its place in the text."""
    turns = formatted.select("conv_id", "formatted", "loss", parsed(F.col("formatted")).alias("turns"))
    sha = lambda parts: F.sha2(F.array_join(parts, ""), 256)
    each = turns.select("conv_id", F.posexplode("turns").alias("n", "t"))
    order = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("base", F.coalesce(F.sum("t.size").over(order), F.lit(0))).select("conv_id", "n", (F.col("base") + F.col("t.start")).alias("start"), (F.col("base") + F.col("t.end")).alias("end"), F.col("t.text").alias("text"))
    spans = formatted.select("conv_id", F.explode("loss").alias("s")).select(F.col("conv_id").alias("c"), F.col("s.start").alias("s"), F.col("s.end").alias("e"))
    masked = placed.join(spans, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("start") == F.col("s")) & (F.col("end") == F.col("e")))
    learned = masked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("l"))
    loss = learned.select(F.col("conv_id").alias("c"), F.array_join(F.transform("l", lambda x: x["text"]), "").alias("learned"))
    full = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
    text = F.coalesce("learned", F.lit(""))
    return full.join(loss, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"), F.sha2(text, 256).alias("loss_sha256"), "formatted_chars")


def format_rows(rows: DataFrame, **names: str) -> DataFrame:
    """``conv_id, formatted, loss`` of a table of finished messages."""
    return render(fold_events(events_of_rows(rows, **names)))
