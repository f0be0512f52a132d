"""Sums and means of doubles that do not depend on the layout of the rows.

Adding doubles rounds at every step, so their sum hangs on the order in which
tasks meet the rows. Here a double is cut, without loss, into whole numbers of
2^(32 k) for a few neighbouring k (its bins). Whole numbers add up exactly in any
order, so each bin's total is exact; the totals of all bins are then put together
and rounded to a double once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bin; a double of 53 bits touches three at most, or four if its
#: highest one was guessed one too high.
BITS, TOUCHED = 32, 4
#: Values below 2^SMALL are scaled by 2^LIFT first, as their lowest bins have no
#: double as unit.
SMALL, LIFT = -700, 512
UNITS = "decimal(18,0)"
WHOLE = "decimal(38,0)"


def _power(bins: Column) -> Column:
    return F.pow(F.lit(2.0), bins * BITS)


def with_parts(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the bins of the finite doubles in ``value`` as an array of ``bin,
    units``, whose sum of units * 2^(32 bin) is the value, exactly; zeros, nulls
    and others have no bins. One projection a step, so each is computed once."""
    x = F.col(value)
    cut = df.withColumn("_x", F.when(~F.isnan(x) & (F.abs(x) != float("inf")) & (x != 0), x))
    cut = cut.withColumn("_tiny", F.abs("_x") < 2.0 ** SMALL)
    cut = cut.withColumn("_rest", F.when(F.col("_tiny"), F.col("_x") * 2.0 ** LIFT).otherwise(F.col("_x")))
    cut = cut.withColumn("_top", F.floor(F.log2(F.abs("_rest")) / BITS).cast("int"))
    parts = []
    for k in range(TOUCHED):
        unit = _power(F.col("_top") - k)
        cut = cut.withColumn(f"_u{k}", F.when(F.col("_rest") < 0, F.ceil(F.col("_rest") / unit)).otherwise(F.floor(F.col("_rest") / unit)).cast(UNITS))
        cut = cut.withColumn("_rest", F.col("_rest") - F.col(f"_u{k}").cast("double") * unit)
        place = (F.col("_top") - k - F.when(F.col("_tiny"), LIFT // BITS).otherwise(0)).cast("int")
        parts.append(F.struct(place.alias("bin"), F.col(f"_u{k}").alias("units")))
    cut = cut.withColumn(name, F.filter(F.array(*parts), lambda p: p["units"] != 0))
    return cut.select(*df.columns, name)


def _digits(totals: Column, sign: int) -> Column:
    """``totals`` (one whole number per bin, ascending) with carries handed on:
    ``digits`` from 0 to 2^32 - 1, and the last ``carry``, which has the sign."""
    base = F.lit(1 << BITS).cast(WHOLE)
    start = F.struct(F.lit(0).cast(WHOLE).alias("carry"), F.array().cast(f"array<{WHOLE}>").alias("digits"))

    def step(acc: Column, t: Column) -> Column:
        whole = (acc["carry"] + sign * t).cast(WHOLE)
        digit = F.pmod(whole, base).cast(WHOLE)
        return F.struct(((whole - digit) / base).cast(WHOLE).alias("carry"), F.concat(acc["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(totals, start, step)


def _with_rounded(df: DataFrame, totals: str, low: str, name: str) -> DataFrame:
    """Adds the double nearest to the sum of totals[i] * 2^(32 (low + i)), null
    for null totals. One projection a step, as above."""
    base = F.lit(1 << BITS).cast(WHOLE)
    out = df.withColumn("_plus", _digits(F.col(totals), 1)).withColumn("_minus", _digits(F.col(totals), -1))
    out = out.withColumn("_neg", F.col("_plus.carry") < 0)
    out = out.withColumn("_digits", F.when(F.col("_neg"), F.col("_minus.digits")).otherwise(F.col("_plus.digits")))
    # place of the highest digit; three digits and one bit for all below are enough to round by
    out = out.withColumn("_high", F.array_max(F.transform("_digits", lambda d, i: F.when(d != 0, i))))

    def digit(back: int) -> Column:
        i = F.col("_high") - back
        return F.when(i >= 0, F.element_at("_digits", F.greatest(i, F.lit(0)) + 1)).otherwise(F.lit(0).cast(WHOLE))

    below = F.exists(F.slice("_digits", 1, F.greatest(F.col("_high") - 2, F.lit(0))), lambda d: d != 0)
    three = ((digit(0) * base + digit(1)).cast(WHOLE) * base + digit(2)).cast(WHOLE)
    out = out.withColumn("_value", (three * 2 + F.when(below, 1).otherwise(0)).cast(WHOLE).cast("double"))
    # scaled in two steps, as the unit of the lowest bins has no double
    out = out.withColumn("_scale", BITS * (F.col(low) + F.col("_high") - 2) - 1).withColumn("_half", F.floor(F.col("_scale") / 2))
    value = F.col("_value") * F.pow(F.lit(2.0), F.col("_half").cast("double")) * F.pow(F.lit(2.0), (F.col("_scale") - F.col("_half")).cast("double"))
    rounded = F.when(F.col(totals).isNull(), F.lit(None).cast("double")).when(F.col("_high").isNull(), 0.0).when(F.col("_neg"), -value).otherwise(value)
    return out.select(*df.columns, rounded.alias(name))


def exact_sums(df: DataFrame, keys: Sequence[str], value: str, name: str = "sum", count: str = "n") -> DataFrame:
    """``keys``, the sum of the doubles in ``value`` and their number, per group.

    The sum is the double nearest to the true one, so it has the same bytes for
    the same values in any order and partitioning, whatever their sizes. Nulls
    are left out; a group of nulls has a null sum and count 0. NaN, or infinities
    of both signs, give NaN; else an infinity gives itself. A sum beyond the
    largest double is an infinity. Below 2^-1022 the last bit may be off.

    Rows become at most four (group, bin) rows, which partial aggregates reduce
    before the shuffle: a group of any size sends some sixty rows per task."""
    x = F.col("_v")
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    cut = with_parts(df.select(*keys, F.col(value).cast("double").alias("_v")), "_v", "_parts")
    one = F.array(F.struct(F.lit(None).cast("int").alias("bin"), F.lit(None).cast(UNITS).alias("units")))
    rows = cut.select(*keys, F.when(x.isNotNull(), 1).otherwise(0).alias("_n"), F.when(odd, x).alias("_odd"), F.explode(F.concat(one, "_parts")).alias("_p"))
    per_bin = rows.groupBy(*keys, F.col("_p.bin").alias("_bin")).agg(
        F.sum("_p.units").cast(WHOLE).alias("_units"), F.sum("_n").alias("_n"), F.sum("_odd").alias("_odd"))
    bins = F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col("_units").alias("units"))))
    per_key = per_bin.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(bins)).alias("_bins"), F.min("_bin").alias("_low"), F.max("_bin").alias("_top"),
        F.max(F.when(F.col("_bin").isNull(), F.col("_n"))).alias(count), F.max(F.when(F.col("_bin").isNull(), F.col("_odd"))).alias("_odd"))
    # two bins above the highest take the carries
    every = F.transform(F.sequence(F.col("_low"), F.col("_top") + 2), lambda k: F.coalesce(F.try_element_at("_bins", k), F.lit(0).cast(WHOLE)))
    summed = _with_rounded(per_key.withColumn("_totals", every), "_totals", "_low", "_sum_")
    total = F.when(F.col(count) == 0, F.lit(None).cast("double")).when(F.col("_odd").isNotNull(), F.col("_odd")).otherwise(F.coalesce("_sum_", F.lit(0.0)))
    return summed.select(*keys, total.alias(name), count)


def exact_means(df: DataFrame, keys: Sequence[str], value: str, name: str = "mean", count: str = "n") -> DataFrame:
    """``keys``, the mean of the doubles in ``value`` (the sum of
    :func:`exact_sums`, divided once) and their number, per group."""
    out = exact_sums(df, keys, value, "_sum", count)
    return out.select(*keys, F.try_divide("_sum", count).alias(name), count)
