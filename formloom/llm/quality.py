"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A document is the average of the learned vectors of its hashed features: its words, their character n-grams, and marks
of words that repeat one of the two words before. A softmax over that average gives the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_SEPARATORS, discard, materialize, remainder_of_id, slices, text_bytes, word_hashes, word_spans

#: Separators become blanks, which mark the edges of a word in its n-grams.
BLANK = bytes(0x20 if b in WORD_SEPARATORS else b for b in range(256))
IS_WORD = np.array([b not in WORD_SEPARATORS for b in range(256)], np.int8)


@dataclass(frozen=True)
class Settings:
    """bits: of the hashed table. grams: lengths of n-grams in bytes. sample: the bound on labelled rows that are fitted.
    held: bytes of their features that the driver holds; beyond that each epoch reads them from the shared folder."""

    bits: int = 17
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    sample: int = 3000
    held: int = 256 << 20
    epochs: int = 12
    rate: float = 0.4
    batch: int = 16
    seed: int = 42


def features(texts: list[bytes], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature the ids in all texts, one text after the other, and where each text's begin and the last ends."""
    joined = b" ".join([b"", *(t.translate(BLANK) for t in texts), b""])
    buf = np.frombuffer(joined, np.uint8)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, ends = word_spans(buf, IS_WORD)
    h = word_hashes(buf, starts, ends)
    out = []
    with np.errstate(over="ignore"):
        first = np.searchsorted(starts, edges)
        out.append(((h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - s.bits)).astype(np.uint32), first))
        for back in (1, 2):
            again = np.flatnonzero(h[back:] == h[:-back]) + back
            again = again[again - back >= first[np.searchsorted(first, again, side="right") - 1]]  # both in one text
            out.append((np.full(len(again), back, np.uint32), np.searchsorted(starts[again], edges)))
        inside = IS_WORD[buf].astype(bool)
        x = buf.astype(np.uint32) + np.uint32(1)
        for n in s.grams:
            m = len(buf) - n + 1
            if m <= 0:
                continue
            g = np.full(m, n, np.uint32)
            for i in range(n):
                g *= np.uint32(0x01000193)
                g += x[i : i + m]
            valid = inside[1 : m + 1].copy()
            for i in range(2, n - 1):
                valid &= inside[i : i + m]
            at = np.flatnonzero(valid)
            out.append((g[at] * np.uint32(0x9E3779B1) >> np.uint32(32 - s.bits), np.searchsorted(at, edges)))
    return out


def feature_counts(texts: list[bytes], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct feature ids of each text and how often it has each."""
    kinds = features(texts, s)
    return [np.unique(np.concatenate([ids[at[i] : at[i + 1]] for ids, at in kinds]), return_counts=True) for i in range(len(texts))]


@dataclass
class Model:
    """weights: log-odds that each feature adds on average; bias: those of a text without features."""

    settings: Settings
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1."""
        sums, n = np.zeros(len(texts)), np.zeros(len(texts))
        for ids, at in features(texts, self.settings):
            up_to = np.concatenate(([0.0], np.cumsum(self.weights[ids], dtype=np.float64)))
            sums += up_to[at[1:]] - up_to[at[:-1]]
            n += np.diff(at)
        return 1 / (1 + np.exp(-np.clip(sums / np.maximum(n, 1) + self.bias, -60, 60)))


#: Feature ids of a text and how often it has each.
Row = tuple[np.ndarray, np.ndarray]


def train(rows_in: Callable[[np.ndarray], Iterator[Row]], lengths: np.ndarray, labels: np.ndarray, s: Settings) -> Model:
    """Fit feature vectors and softmax by minibatch gradient descent with a falling rate (AdaGrad steps for each vector).

    lengths: of each row how many features it has, repeats counted; a row without any is left out. rows_in(order): the
    features of the rows in an order, which may be read anew for each epoch.
    """
    rng = np.random.default_rng(s.seed)
    size = 1 << s.bits
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (size, s.dim)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    if not len(labels):
        return Model(s, np.zeros(size, np.float32), 0.0)
    share = np.bincount(labels, minlength=2) / len(labels)
    bias[:] = np.log(np.maximum(share, 1e-3))
    seen, seen_out = np.full(size, 1e-6, np.float32), np.full(out.shape, 1e-6, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    lengths = lengths.astype(np.float32)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        order = rng.permutation(len(labels))
        order = order[lengths[order] > 0]
        source = rows_in(order)
        for at in range(0, len(order), s.batch):
            rows = order[at : at + s.batch]
            part = [next(source) for _ in rows]
            sizes = [len(x) for x, _ in part]
            ids = np.concatenate([x for x, _ in part])
            w = np.concatenate([c / lengths[i] for i, (_, c) in zip(rows, part, strict=True)])
            starts = np.cumsum([0, *sizes[:-1]])
            v = vectors[ids]
            hidden = np.add.reduceat(v * w[:, None], starts)
            z = hidden @ out + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = z / z.sum(1, keepdims=True) - target[rows]
            back = error @ out.T
            grad = hidden.T @ error
            seen_out += grad**2
            out -= rate * grad / np.sqrt(seen_out)
            bias -= 0.05 * rate * error.mean(0)
            g = np.repeat(back, sizes, axis=0) * w[:, None]
            touched, inverse = np.unique(ids, return_inverse=True)
            sums = np.stack([np.bincount(inverse, g[:, d], len(touched)) for d in range(s.dim)], 1).astype(np.float32)
            seen[touched] += (sums**2).mean(1)
            vectors[touched] -= 0.5 * rate * sums / np.sqrt(seen[touched])[:, None]
    delta = out[:, 1] - out[:, 0]
    return Model(s, vectors @ delta, float(bias[1] - bias[0]))


def fit(
    docs: DataFrame, labels: DataFrame, s: Settings = Settings(), *, folds: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text",  # noqa: B008  frozen
) -> Model:
    """Fit on at most s.sample labelled rows, those with the least hashes of their ids, never on the held-out fold.

    labels: doc_id, quality (0 or 1; nulls are no label; of several rows of an id the least counts). A null id has no
    label. Of several rows of docs with one id that with the least features counts. The sampled documents' hashed features,
    all of them, are a table in the shared folder; the driver holds them if they are s.held bytes or less, and else reads
    them once an epoch, a partition at a time and in the same order, so the model is the same. Other columns are ignored.
    """
    spark = docs.sparkSession
    own = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    own = own.filter(remainder_of_id("doc_id", folds) != held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            pairs = feature_counts(text_bytes(b.column("text")), s)
            cols = [b.column("doc_id"), b.column("quality"), *(pa.array([p[k].astype(t).tobytes() for p in pairs], pa.binary()) for k, t in enumerate(("<u4", "<f4")))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "quality", "ids", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(own), "doc_id").select("doc_id", "text", "quality")
    found = given.mapInArrow(run, f"doc_id {kind}, quality int, ids binary, counts binary")
    found = materialize(found.groupBy("doc_id").agg(F.min(F.struct("ids", "counts", "quality")).alias("f")).select("doc_id", "f.*"), "features")
    known = sorted((r["doc_id"], r["quality"], r["n"]) for r in found.select("doc_id", "quality", F.octet_length("ids").alias("n")).collect())  # s.sample rows
    place = spark.createDataFrame([(r[0], k) for k, r in enumerate(known)], f"doc_id {kind}, k long") if known else None
    row = lambda r: (np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["counts"], "<f4"))

    def read(order: np.ndarray) -> Iterator[Row]:
        turn = spark.createDataFrame([(known[k][0], at) for at, k in enumerate(order.tolist())], f"doc_id {kind}, at long")
        return map(row, found.join(F.broadcast(turn), "doc_id").orderBy("at").select("ids", "counts").toLocalIterator())

    if known and 2 * sum(r[2] for r in known) <= s.held:
        held = {r["k"]: row(r) for r in found.join(F.broadcast(place), "doc_id").select("k", "ids", "counts").collect()}
        model = train(lambda order: (held[k] for k in order.tolist()), np.array([held[k][1].sum() for k in range(len(known))]), np.array([r[1] for r in known], np.int64), s)
    else:
        order = np.arange(len(known))
        lengths = np.array([c.sum() for _, c in read(order)] if known else [])
        model = train(read, lengths, np.array([r[1] for r in known], np.int64), s)
    discard(found)
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """One row for each row of docs: doc_id, score (0 to 1), predicted (1 if score >= cut).

    Only the text is read. Null and empty texts have no features and get the score of the bias, the share of label 1 in
    the sample; so have all texts if nothing is labelled, when it is 1/2. Equal texts have equal scores; other columns are
    ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.scores(text_bytes(b.column("text"))))], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns whatever their names, whose score() is at least `cut`; repeated rows alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 2 << 20):
            yield b.filter(pa.array(shared.value.scores(text_bytes(b.column(text_col))) >= cut))

    return docs.mapInArrow(run, docs.schema)
