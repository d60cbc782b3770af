"""Hard-negative mining by norm-bucketed search: candidates in buckets of like norm, pruned by the Cauchy-Schwarz bound."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Scores up to this size are exact in 64-bit floats; beyond it whole numbers of Python are used.
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def packed_vectors(vectors: list[np.ndarray]) -> tuple[bytes, int, int]:
    """Vectors as rows of the narrowest integers that hold them, shorter ones with zeros at the end; bytes, width and dimension."""
    dim = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    low, high = (int(out.min()), int(out.max())) if out.size else (0, 0)
    width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return out.astype(f"<i{width}").tobytes(), width, dim


def unpacked_vectors(data: bytes, width: int, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(n, dim)


def inner_products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of all rows of a with all of b, of which none is larger than bound; beyond 64 bits the nearest long."""
    dim = min(a.shape[1], b.shape[1])
    if bound < EXACT:
        return (a[:, :dim].astype(np.float64) @ b[:, :dim].astype(np.float64).T).astype(np.int64)
    whole = a[:, :dim].astype(object) @ b[:, :dim].astype(object).T if dim else np.zeros((len(a), len(b)), object)
    return np.clip(whole, LEAST, MOST).astype(np.int64)


def blocks(rows: DataFrame, extra: list[str], size: int, most_bytes: int = 1 << 20) -> DataFrame:
    """rows (id, label, v, norm, and `extra` lists of longs of one length) by falling norm, in blocks of `size` rows at most.

    A block is one row: its largest norm, the least of its `low` limits, ids, labels, vectors and extra columns as packed integers. The rows are dealt by
    ranges of (norm, id), so blocks of equal norms are spread like any others.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        n = 0

        def block() -> pa.RecordBatch:
            data, width, dim = packed_vectors([np.asarray(r["v"], np.int64) for r in held])
            longs = lambda c: np.array([r[c] for r in held], "<i8").tobytes()
            row = {"norm": [float(held[0]["norm"])], "n": [len(held)], "width": [width], "dim": [dim], "ids": [longs("id")], "labels": [longs("label")], "norms": [np.array([r["norm"] for r in held], "<f8").tobytes()], "vectors": [data]}
            row |= {"least": [float(np.min([r["low"] for r in held]))] if "low" in extra else [0.0]} | {c: [longs(c)] for c in extra}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("norm", pa.float64()), ("n", pa.int32()), ("width", pa.int32()), ("dim", pa.int32()), ("least", pa.float64()), *((c, pa.binary()) for c in ("ids", "labels", "norms", "vectors", *extra))]))

        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                n += 8 * len(r["v"])
                if len(held) >= size or n >= most_bytes:
                    yield block()
                    held, n = [], 0
        if held:
            yield block()

    order = [F.col("norm").desc(), F.col("id")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "label", "v", "norm", *extra)
    schema = "norm double, n int, width int, dim int, least double, ids binary, labels binary, norms binary, vectors binary"
    return dealt.mapInArrow(pack, schema + "".join(f", {c} binary" for c in extra))


class Best:
    """The k best of each of some windows so far: by falling score, then rising id. low, high: the windows' limits."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.high, self.floor = k, high.ravel(), low.ravel().copy()
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        w, s, i = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.id, id_)))
        order = np.lexsort((i, ~s, w))  # ~s falls as s rises, for any long
        w, s, i = w[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else np.zeros(0, np.int64)
        place = np.arange(len(w)) - np.repeat(first, np.diff(np.concatenate((first, [len(w)]))))
        keep = place < self.k
        self.window, self.score, self.id = w[keep], s[keep], i[keep]
        last = place == self.k - 1
        self.floor[w[last]] = np.maximum(self.floor[w[last]], s[last])


def nearest(candidates: DataFrame, anchors: DataFrame, k: int, windows: int, same_label: bool, names: list[str], rounds: int) -> DataFrame:
    """Of each anchor's windows the k best candidates within their limits that each task has seen.

    candidates, anchors: blocks(); anchors have `low`, `high` (limits of each window, by row) and the columns `names`, also
    by window, which are carried along. Anchors are dealt into `rounds` shares of bounded size; each is joined, as blocks,
    with the candidates' blocks that its bound can't rule out: a block whose largest norm times the anchors' is below
    the least limit holds nothing. A task meets its blocks by falling norm and skips, of each anchor, what is below its limits
    and its running k-th score.
    """
    fields = ["anchor", *names, "other", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] not in state:
                    n = r["a_n"]
                    longs = lambda c, r=r, n=n: np.frombuffer(r[f"a_{c}"], "<i8").reshape(n, -1)
                    best = Best(k, longs("low"), longs("high"))
                    state[r["block"]] = best, longs("ids")[:, 0], longs("labels")[:, 0], np.frombuffer(r["a_norms"], "<f8"), unpacked_vectors(r["a_vectors"], r["a_width"], r["a_dim"], n), {c: longs(c).ravel() for c in names}
                best, ids, labels, norms, vectors, _ = state[r["block"]]
                floor = best.floor.reshape(-1, windows)
                open_ = (norms[:, None] * r["norm"] * (1 + 1e-9) + 1 >= floor) & (floor <= best.high.reshape(-1, windows))
                rows = np.flatnonzero(open_.any(1))
                if not len(rows):
                    continue
                other = np.frombuffer(r["ids"], "<i8")
                score = inner_products(vectors[rows], unpacked_vectors(r["vectors"], r["width"], r["dim"], r["n"]), float(norms[rows].max()) * r["norm"])
                fits = (labels[rows][:, None] == np.frombuffer(r["labels"], "<i8")) == same_label
                fits &= ids[rows][:, None] != other
                found = []
                for w in range(windows):
                    own = rows * windows + w
                    i, j = np.nonzero(fits & (score >= best.floor[own][:, None]) & (score <= best.high[own][:, None]) & open_[rows, w][:, None])
                    found.append((own[i], score[i, j], other[j]))
                best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
        for best, ids, *_, extra in state.values():
            cols = [ids[best.window // windows], *(extra[c][best.window] for c in names), best.id, best.score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], fields)

    few = anchors.withColumn("block", F.xxhash64("ids", "low"))
    few = few.select("block", F.pmod("block", F.lit(rounds)).alias("round"), *(F.col(c).alias(f"a_{c}") for c in anchors.columns))
    out = []
    for k_ in range(rounds):
        share = F.broadcast(few.filter(F.col("round") == k_))  # 64 blocks of 1 MB in the middle, whatever the number of anchors
        met = candidates.drop("least").join(share, F.col("norm") * F.col("a_norm") * (1 + 1e-9) + 1 >= F.col("a_least"))
        out.append(met.drop("round", "a_norm", "a_least").mapInArrow(search, ", ".join(f"{c} long" for c in fields)))
    return reduce(DataFrame.unionAll, out)


def mine(
    rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", size: int = 1024, anchors_size: int = 256, at_once: int = 64,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the best negatives within each pair's window.

    Vectors' components become floor(scale * x). A score is the integer inner product; higher ones come first, of equal ones
    the smaller id. An anchor's positives are the first `positives` other rows of its label; a negative has another label
    and low * positive_score <= 100 * score <= high * positive_score; of each pair the first `negatives` are ranked from 1.
    A positive without such a negative has no row (so has one of a negative score, as its window is empty).

    Rows whose label, id or vector is null, or that have a null or non-finite component, take no part; of several rows of one
    id, repeated ones too, that with the least label, then vector. A shorter vector counts as if it had zeros at the end.
    Components of 2^63 or more count as the nearest long, and so do scores. Other columns are ignored; an empty table, or one
    without anchors, gives an empty result.

    is_anchor: a condition on the id. A task holds one block of candidates (`size` rows), `at_once` blocks of anchors, about,
    and for each of their windows the best so far; what tasks have found is ranked by anchor and positive.
    """
    x = F.col("v")
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    given = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
    given = given.filter(F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))))
    given = given.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", F.transform("r.v", lambda y: F.floor(y * F.lit(scale))).alias("v"))
    given = given.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double"))))
    given = materialize(given, "vectors")
    candidates = materialize(blocks(given, [], size), "candidates")
    anchors = given.filter(is_anchor.alias("a"))

    def search(some: DataFrame, k: int, windows: int, same_label: bool, names: list[str]) -> DataFrame:
        grouped = materialize(blocks(some, ["low", "high", *names], anchors_size), "anchors")
        found = materialize(nearest(candidates, grouped, k, windows, same_label, names, max(1, -(-grouped.count() // at_once))), "found")
        discard(grouped)
        return found

    def first(found: DataFrame, k: int, *by: str) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "other"))).filter(F.col("rank") <= k)

    any_ = anchors.select("id", "label", "v", "norm", F.array(F.lit(LEAST)).alias("low"), F.array(F.lit(MOST)).alias("high"))
    pairs = first(search(any_, positives, 1, True, []), positives, "anchor")
    slot = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.get("p", i))
    part = lambda s, share: s["score"].cast("decimal(20,0)") * F.lit(share) / F.lit(100)  # noqa: E731  exact, and no overflow
    each = lambda f, missing: F.transform(slot, lambda s: F.coalesce(f(s).cast("long"), F.lit(missing).cast("long")))
    pairs = pairs.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p")).select(
        "anchor", each(lambda s: F.ceil(part(s, low)), 1).alias("low"), each(lambda s: F.floor(part(s, high)), 0).alias("high"),
        each(lambda s: s["other"], 0).alias("positive"), each(lambda s: s["score"], 0).alias("positive_score"),
    )
    given_pairs = anchors.join(pairs, F.col("id") == F.col("anchor")).select("id", "label", "v", "norm", "low", "high", "positive", "positive_score")
    found = first(search(given_pairs, negatives, positives, False, ["positive", "positive_score"]), negatives, "anchor", "positive")
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
