"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Each word becomes one mark, which are counted by length; no array of words is made."""
    marks = F.regexp_replace(text, WORD_PATTERN, "w")
    return F.coalesce(F.length(marks) - F.length(F.replace(marks, F.lit("w"), F.lit(""))), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, *, budget: float, max_epochs: int = 2) -> DataFrame:
    """Targets of sources: `source`, `source_size` and a whole-numbered `weight` in, these and `target` out.

    `budget` times the sum of all sizes is shared by weight; a source above `max_epochs` times its size is clamped there
    and its excess shared among the rest by weight, until none is above. The fixed point is found at once: in the order of
    cap / weight the clamped sources are a prefix, and the level is what is left over the weight that is left. budget is
    taken in thousandths. If all are clamped, the targets are the caps. One row for each source goes through one window.
    """
    thousandths = round(budget * 1000)
    every = Window.partitionBy()
    order = Window.partitionBy().orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = sizes.withColumn("cap", F.col("source_size") * max_epochs)
    s = s.withColumns({
        "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0)), "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "total": F.sum("source_size").over(every),
    })
    s = s.withColumn("level", (F.col("total") * thousandths - F.col("caps_before") * 1000) / F.lit(1000.0) / F.col("weight_left"))
    s = s.withColumn("clamped", F.col("level") * F.col("weight") >= F.col("cap"))
    # once a source isn't clamped, no later one is; the level of the first such source holds for all of them
    s = s.withColumn("final", F.first(F.when(~F.col("clamped"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("final") * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame, *, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, max_epochs: int = 2, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, repetitions, taken.

    Sources by code point, null last as a source of its own, have the weights in turn. Of a source with target t and size
    s each document is taken floor(t / s) times, and once more if its seeded place is in the fraction that is left: places
    are md5 digests of seed and doc_id, whose first three digits deal a source into 4096 bins. Bins are taken whole up to
    the last, and in that the documents by digest, as long as at least half of one fits; so a source comes within half of
    a document of its target. Sums of bins, not documents, are put in order, so a source of any size is spread over all
    tasks. Repeated rows have one place and are taken in the order of their sizes; texts that are null or blank have size
    0 and are taken 0 words, and are repeated `max_epochs` times at most like all others; other columns are ignored; an
    empty table gives an empty result. Reruns agree.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), digest.alias("digest"))
    d = materialize(d.withColumn("bin", F.substring("digest", 1, 3)), "sizes")
    bins = materialize(d.groupBy("source", "bin").agg(F.sum("size").alias("size")), "bins")
    sizes = bins.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    targets = water_fill(sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long")), budget=budget, max_epochs=max_epochs)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(times).cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).drop("weight")

    up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    at = bins.withColumn("before", F.coalesce(F.sum("size").over(up_to), F.lit(0))).withColumnRenamed("size", "bin_size")
    same = lambda a, b, *names: [a[n].eqNullSafe(b[n]) for n in names]
    at = at.join(targets, same(at, targets, "source"), "inner").drop(targets["source"])
    at = at.withColumn("kind", F.when(F.col("rest") <= 0, 0).when(F.col("before") + F.col("bin_size") <= F.col("rest"), 2).when(F.col("before") >= F.col("rest"), 0).otherwise(1))
    # without a hint the documents are what Spark broadcasts, twice, as their stored table is small for its rows
    all_ = d.join(at.hint("merge"), same(d, at, "source", "bin"), "inner").drop(at["source"], at["bin"])
    edge = Window.partitionBy("source").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = all_.filter("kind = 1").withColumn("fits", F.col("before") + F.sum("size").over(edge) - F.col("size") / 2 <= F.col("rest"))
    rest = all_.filter("kind <> 1").withColumn("fits", F.col("kind") == 2)
    out = rest.unionByName(last).withColumn("repetitions", F.col("whole") + F.col("fits").cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "repetitions", (F.col("repetitions") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, mixed: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: each row of docs as often as `mixed` says for its id, with the columns of docs, whatever their names.

    Rows of docs that share an id are each repeated as often as the most taken of them; a null id is one like any other.
    """
    times = mixed.groupBy(F.col("doc_id").alias("id")).agg(F.max("repetitions").cast("int").alias("times"))
    both = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")).join(times, F.col(f"row.`{id_col}`").eqNullSafe(F.col("id"))).filter("times > 0")
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
