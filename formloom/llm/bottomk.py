"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k least distinct 64-bit hashes of a text's word shingles. Sketches of parts merge
into the sketch of the whole and estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, lower_ascii, materialize

K, WORDS = 128, 5


def sketch(text: Column, *, k: int = K, words: int = WORDS) -> Column:
    """Sketch of a text: A-Z lower-cased, `words` words a shingle; fewer words are one shingle, no words none."""
    split = F.split(F.trim(F.translate(lower_ascii(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     ")), " +")

    def of(parts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - words, F.lit(0)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(parts, i + k) for k in range(words)))))  # beyond the end null, which adds nothing
        return F.when(F.element_at(parts, 1) == "", F.array().cast("array<bigint>")).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k))

    return let(split, of)


def merge(a: Column, b: Column, *, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(df: DataFrame, keys: list[str], column: str, *, k: int = K, fan: int = 64) -> DataFrame:
    """Sketch of all rows of each key. Hashes are first cut to the k least in `fan` salted parts, so a hot key is spread."""
    h = df.select(*keys, F.explode(column).alias("h")).withColumn("salt", F.pmod("h", F.lit(fan))).distinct()
    least = lambda x: F.slice(F.array_sort(F.collect_list(x)), 1, k)
    ranked = h.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "salt").orderBy("h"))).filter(F.col("r") <= k)
    return ranked.groupBy(*keys).agg(least("h").alias(column))


def resemblance(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated Jaccard similarity: of the k least hashes of both, the share that both have. Two empty sketches: 1."""
    share = lambda both: F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both))
    return let(merge(a, b, k=k), share)


def distinct_count(a: Column, *, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th hash's place in the range."""
    place = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, from resemblance and counts. Of an empty a: 1."""
    shared = let(resemblance(a, b, k=k), lambda j: j / (1 + j)) * (distinct_count(a, k=k) + distinct_count(b, k=k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k=k)))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def neighbours(keys: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each distinct (doc_id, h) with the next one in descending order; after the last comes the first.

    Ids are dealt out by range and numbered inside their range; only the ends of ranges, one row each, meet in one task.
    """
    desc = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    dealt = keys.repartitionByRange(*desc) if partitions is None else keys.repartitionByRange(partitions, *desc)
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    inner = Window.partitionBy("part").orderBy(*desc)
    row = F.struct("doc_id", "h")
    placed = dealt.withColumn("next", F.lead(row).over(inner))
    heads = dealt.withColumn("r", F.row_number().over(inner)).filter("r = 1").select("part", row.alias("own"))
    ring = Window.partitionBy().orderBy("part")
    heads = heads.withColumns({"follow": F.coalesce(F.lead("own").over(ring), F.first("own").over(ring))}).select("part", "follow")
    return placed.join(heads, "part").select("doc_id", "h", "n_chars", F.coalesce("next", "follow").alias("next"))


def edited_pairs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is replaced by the start of the next document.

    One row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    distinct_shingles, contained_edited, next_doc_id, next_n_chars. The next document is that with the next lower doc_id,
    after the last the highest one. Equal rows count as one document there; several texts of one doc_id follow each other by
    hash, and null ids come last. A null text counts as empty. A single document is its own next one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.length(text).cast("long").alias("n_chars"))
    d = d.withColumn("s", sketch(F.col("text"), k=k, words=words))
    keys = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), F.length(text).cast("long").alias("n_chars"))
    counted = materialize(keys.groupBy("doc_id", "h").agg(F.first("n_chars").alias("n_chars"), F.count("*").alias("times")), "keys")
    repeated = bool(counted.filter("times > 1").limit(1).count())
    ids = neighbours(counted.drop("times"))


    # the start of each next document, as long as the document before it needs, goes to that document
    need = ids.select(
        F.col("next.doc_id").alias("at_id"), F.col("next.h").alias("at_h"), F.col("doc_id").alias("to_id"), F.col("h").alias("to_h"), F.floor(F.col("n_chars") / 3).cast("int").alias("give")
    )
    sent = d.join(need, d["doc_id"].eqNullSafe(need["at_id"]) & (d["h"] == need["at_h"]))
    sent = sent.select("to_id", "to_h", F.substring("text", F.lit(1), F.col("give")).alias("head"), F.col("s").alias("next_s"), F.col("doc_id").alias("next_doc_id"), F.col("n_chars").alias("next_n_chars"))
    sent = sent.groupBy("to_id", "to_h").agg(*(F.first(c).alias(c) for c in ("head", "next_s", "next_doc_id", "next_n_chars"))) if repeated else sent
    e = d.join(sent, d["doc_id"].eqNullSafe(sent["to_id"]) & (d["h"] == sent["to_h"]))
    e = e.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")), "head"))
    e = e.withColumn("es", sketch(F.col("edited"), k=k, words=words))
    return e.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("s")).alias("fingerprint"), as_text(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es"), k=k).alias("near_edited"), resemblance(F.col("s"), F.col("next_s"), k=k).alias("near_next"),
        distinct_count(F.col("s"), k=k).alias("distinct_shingles"), containment(F.col("s"), F.col("es"), k=k).alias("contained_edited"), "next_doc_id", "next_n_chars",
    )
