"""SimHash near-duplicates: pivot distance tables discard pairs, exact Hamming distances verify the rest."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_copies
from .common import discard, materialize, slices, text_bytes
from .fingerprint import by_group, hamming, majority, pairs_within, spanning

#: Rows of a bucket that are compared pair by pair; larger ones are searched from one fingerprint to all.
SMALL = 256


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of its word shingles."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[words - 1 :] - 1).tolist() if len(parts) >= words else [len(joined)]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], np.uint64))  # noqa: B905  as many as stops


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id, a hash `h` of the text and the fingerprint `fp` (a signed long) of each row; null and blank texts have zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t, words) for t in text_bytes(b.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(fp)], ["doc_id", "h", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    return own.mapInArrow(run, f"doc_id {kind}, h long, fp long")


def reference_fingerprints(n: int, seed: int = 42) -> np.ndarray:
    """The pivots: n seeded random fingerprints."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def pivot_table(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all values to each pivot, a row for each."""
    return np.stack([hamming(values, p) for p in pivots]).astype(np.int8) if len(pivots) else np.zeros((0, len(values)), np.int8)


def linked_roots(values: np.ndarray, table: np.ndarray, most: int) -> np.ndarray:
    """For each of some distinct fingerprints the index of the first one that it is linked to by steps of `most` bits.

    By the triangle inequality two fingerprints whose distances to some pivot differ by more than `most` aren't linked;
    only the pairs that all pivots leave are verified. A fingerprint leaves the search once it is reached, so a group of
    near copies costs about one comparison a member.
    """
    n = len(values)
    root = np.full(n, -1)
    open_ = np.arange(n)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i] = i
        open_ = open_[root[open_] < 0]
        todo = [i]
        while todo and len(open_):
            x = todo.pop()
            left = open_
            for row in table:
                left = left[np.abs(row[left] - row[x]) <= most]
                if not len(left):
                    break
            found = left[hamming(values[left], values[x]) <= most]
            if len(found):
                root[found] = i
                todo += found.tolist()
                open_ = open_[root[open_] < 0]
    return root


def bucket_masks(n: int, most: int) -> list[int]:
    """Masks of the bits in which two fingerprints must agree to meet, of which any pair within `most` bits has one.

    64 bits are cut into blocks, one more than `most` or several; `most` differing bits leave at least that many blocks
    less alike. For n random fingerprints the fewest blocks are taken whose buckets hold about SMALL rows at most.
    """
    for blocks in range(most + 1, most + 5):
        alike = blocks - most
        if n >> (64 * alike // blocks) <= SMALL:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(some) for some in combinations(own, alike)]


def links(distinct: DataFrame, *, most: int = 3, pivots: int = 24) -> DataFrame:
    """Edges `a`, `b` between distinct fingerprints that join all that `most` differing bits link.

    distinct: a column `fp` of distinct values. A fingerprint goes into a bucket for each of bucket_masks(), four of 16 bits
    up to 16 million rows, so that any two within `most` bits meet in one. The table of distances to the pivots is
    computed for all rows of the buckets; in each bucket pairs are discarded by their largest difference in it, and the
    Hamming distances of the survivors verified. What leaves joins each linked set, at most one edge a row and bucket, never
    all pairs. A bucket holds distinct fingerprints, 8 bytes each and a byte for each pivot.
    """
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = bucket_masks(distinct.count(), most)
    keys = F.array(*(F.struct(F.lit(k).cast("byte").alias("part"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("key")) for k, m in enumerate(masks)))
    spread = distinct.select("fp", F.inline(keys)).select(F.xxhash64("part", "key").alias("bucket"), "fp")
    spread = spread.repartition("bucket").sortWithinPartitions("bucket", "fp")
    reference = reference_fingerprints(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, group, n = [], [], 0

        def edges() -> pa.RecordBatch:
            fp = np.concatenate(values)
            i, j, _, _ = pairs_within(fp, np.repeat(np.arange(len(group)), [len(v) for v in values]), pivot_table(fp, reference), most)
            some = np.array(spanning(zip(i.tolist(), j.tolist(), strict=True)), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(fp[some[:, k]].view(np.int64)) for k in (0, 1)], ["a", "b"])

        for g in by_group(batches, ("bucket",)):
            fp = g["fp"].view(np.uint64)
            if len(fp) > SMALL:
                root = linked_roots(fp, pivot_table(fp, reference), most)
                other = np.flatnonzero(root != np.arange(len(fp)))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (fp[root[other]], fp[other])], ["a", "b"])
            elif len(fp) > 1:
                values.append(fp)
                group.append(g["bucket"][0])
                n += len(fp)
                if n > 1 << 15:
                    yield edges()
                    values, group, n = [], [], 0
        if n:
            yield edges()

    return spread.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, narrow: bool = False) -> DataFrame:
    """`node` and `root`, the same for all nodes that edges join: alternating large-star and small-star contraction.

    Each round replaces a star's edges by edges to its least node, which ends after about the logarithm of the longest
    path; the edges of a round are a table in the shared folder, nothing but their number reaches the driver.
    """
    e = materialize(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct(), "edges", narrow)
    stamp = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("s")).first()
    before = stamp(e)
    while before["n"]:
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo < hi").distinct()
        down = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.withColumnRenamed("hi", "u").join(down, "u")
        small = small.select(F.col("m").alias("lo"), F.col("u").alias("hi")).unionAll(small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")))
        new = materialize(small.filter("lo < hi").distinct(), "edges", narrow)
        after = stamp(new)
        discard(e)
        e = new
        if after == before:
            break
        before = after
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, most: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of docs, and for each distinct one its component's least doc_id and its representative row."""
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    distinct = materialize(fps.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    joined = components(links(distinct.select("fp"), most=most, pivots=pivots))
    rooted = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return fps, rooted.select("fp", "root").join(named, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, most: int = 3, pivots: int = 24) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (least doc_id linked, itself included).

    Equal texts, repeated rows and all blank or null texts share a fingerprint and so a component. A null doc_id is in its
    component like any other but never names it, unless it is alone there. Other columns are ignored; an empty table gives
    an empty result.
    """
    fps, of_fp = _grouped(docs, id_col, text_col, words, most, pivots)
    return fps.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def rows_of(docs: DataFrame, kept: DataFrame, all_rows: DataFrame, id_col: str, text: F.Column) -> DataFrame:
    """The rows of docs, with all columns whatever their names, that `kept` (first.doc_id, first.h) names; of repeated rows one.

    all_rows: doc_id and h of all rows, which tell whether any is repeated at all; if none is, nothing is grouped."""
    own = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    names = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.h").alias("kept_h"))
    own = own.join(names, own["id"].eqNullSafe(names["kept_id"]) & (own["h"] == names["kept_h"]), "left_semi")
    if all_rows.groupBy("doc_id", "h").count().filter("count > 1").limit(1).count():
        own = own.dropDuplicates(["id", "h"])
    return own.select("row.*")


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, most: int = 3, pivots: int = 24,
    alike: float | None = None, bands: int = 32, rows: int = 5, limit: int = 1024,
) -> DataFrame:
    """One row of docs of each component, that with the least doc_id (of several texts the least by hash), with all columns.

    Fingerprints link at `most` differing bits; or, with `alike`, texts whose sets of shingles have that Jaccard similarity
    or more. Then texts meet in `bands` buckets of `rows` least hashes (two texts of similarity 0.8 share none of 32 buckets
    of 5 in 1 of 300,000 cases), where a pivot's distances discard pairs and exact sets decide, see near_copies; `limit`
    bounds what a worker holds of a bucket and changes no result. In both ways no two rows that stay are linked, and each row that goes is linked, by a chain, to one that stays.

    Equal texts, repeated rows and all blank or null texts are one component each; null ids come last; an empty table gives
    an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    if alike is not None:
        kept, found = near_copies.groups(docs, id_col, text_col, words, alike, bands, rows, limit, pivots)
        return rows_of(docs, kept, found, id_col, text)
    fps, of_fp = _grouped(docs, id_col, text_col, words, most, pivots)
    return rows_of(docs, of_fp.select("first").distinct(), fps.select("doc_id", "h"), id_col, text)
