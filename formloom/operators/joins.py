"""Joins that a plain equality doesn't carry: overlaps of intervals by bins of time, and hot keys by measured salts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bins(start: Column, end: Column, seconds: int) -> Column:
    """Numbers of the bins of a width that an interval (start included, end not) touches; an empty one none."""
    at = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
    last = F.floor((F.unix_micros(end.cast("timestamp")) - 1) / F.lit(seconds * 1_000_000)).cast("long")
    return F.when(end > start, F.sequence(at(start), last))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, seconds: int, names: tuple[str, str] = ("start", "end")) -> DataFrame:
    """Pairs of rows of equal keys whose intervals (columns `names` on both sides, right's with the prefix r_) overlap.

    Both sides go into the bins they touch and meet there by equality, so no row meets all others of its key. A pair that
    meets in several bins is kept in the one that holds the later start, so nothing has to be made distinct. An interval
    without an end, or that ends before it starts, overlaps nothing. Columns of right but the keys have the prefix r_.
    seconds: the width; a few times the usual length is best, as longer intervals go into more bins.
    """
    start, end = names
    r = right.select(*keys, *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys))
    a = left.withColumn("_bin", F.explode(bins(F.col(start), F.col(end), seconds)))
    b = r.withColumn("_bin", F.explode(bins(F.col(f"r_{start}"), F.col(f"r_{end}"), seconds)))
    met = a.join(b, [*keys, "_bin"])
    later = F.greatest(start, f"r_{start}")
    own = F.floor(F.unix_micros(later.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
    return met.filter((F.col(start) < F.col(f"r_{end}")) & (F.col(f"r_{start}") < F.col(end)) & (F.col("_bin") == own)).drop("_bin")


def salts(big: DataFrame, keys: Sequence[str], per: int) -> DataFrame:
    """The keys of more than `per` rows, with `_parts`: how many parts of about `per` rows each makes. One row a hot key."""
    return big.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > per).select(*keys, F.ceil(F.col("_n") / per).cast("int").alias("_parts"))


def skewed_join(big: DataFrame, small: DataFrame, keys: Sequence[str], *, per: int = 1_000_000, how: str = "inner") -> DataFrame:
    """big joined with small by equal keys, hot keys in parts of about `per` rows (inner or left).

    The rows of each key are counted first. A hot key's rows are dealt to parts by a hash of their content, and its rows of
    small are repeated once for each part, so a task holds a bounded share of the rows however they are spread, and rows of
    other keys are never repeated. The few hot keys are broadcast only if Spark's own limit of bytes allows it.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep each row of big in one part")
    hot = salts(big, keys, per)
    named = hot.select(*(F.col(k).alias(f"_{k}") for k in keys), "_parts")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    parts = F.coalesce("_parts", F.lit(1))
    dealt = big.withColumn("_h", F.xxhash64(*(F.col(f"`{c}`") for c in big.columns))).withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.join(named, same, "left").withColumn("_salt", F.pmod(F.xxhash64("_h", "_row"), parts).cast("int")).drop("_parts", "_h", "_row", *(f"_{k}" for k in keys))
    copied = small.join(named, same, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts", *(f"_{k}" for k in keys))
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")
