"""LM scoring: the likelihood of a text, summed over all segmentations of its words in a subword lattice.

The arcs of a word's lattice are the pieces of an existing tokenizer's vocabulary that match at each place; their unigram
scores weight every segmentation and a forward recursion in log space sums them. In the model of a corpus a word of the
training texts is an arc of its own as well, from the word's start to its end.

Scores of a vocabulary of merges are ranks (0, -1, -2, ...). They stand for probabilities by Zipf's law: the piece of rank
r has a probability in proportion to 1 / (r + 2). Scores that are log probabilities stay as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remainder_of_id, slices, text_bytes

MARK = b" "  # begins a word, as the vocabulary's U+2581 does
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
SLOTS = 20
LONG = 64


class Lattice:
    """The pieces of a sentencepiece vocabulary as bytes, and the recursions over the words they can make."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        own: dict[bytes, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            surface = bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", MARK.decode()).encode()
            if surface and MARK not in surface[1:] and surface not in own:
                own[surface] = sp.get_score(i)
        for b in range(256):
            own.setdefault(bytes([b]), min(own.values()))
        self.pieces = list(own)
        scores = np.array(list(own.values()))
        # merge ranks (0, -1, -2, ...) become probabilities by Zipf's law; log probabilities stay
        self.initial = self.normal(scores if scores.min() > -100 else -np.log(2 - scores - scores.max()))
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.keys = np.append(keys, np.uint64(0))
        self.tables = []
        left = np.arange(len(keys))
        for salt in (1, 2, 3):
            table = np.full(1 << SLOTS, len(keys), np.int32)
            slots = self._slot(keys[left], salt)
            _, first = np.unique(slots, return_index=True)
            table[slots[first]] = left[first]
            left = np.delete(left, first)
            self.tables.append((salt, table))
        if len(left):
            raise ValueError("the vocabulary doesn't fit its table")

    @staticmethod
    def normal(logs: np.ndarray) -> np.ndarray:
        top = logs.max()
        return logs - top - math.log(np.exp(logs - top).sum())

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(BASE) + b + 1) % (1 << 64)
        return h

    @staticmethod
    def _slot(h: np.ndarray, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h ^ (h >> np.uint64(31))) * (MIX * np.uint64(2 * salt + 1)) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash; len(pieces) where there is none."""
        out = np.full(h.shape, len(self.pieces), np.int32)
        for salt, table in self.tables:
            found = table[self._slot(h, salt)]
            out = np.where(self.keys[found] == h, found, out)
        return out

    def arcs(self, x: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For words of one length (rows of bytes) the piece from place j to place i, for all j < i where any word has one."""
        n = x.shape[1]
        x = x.astype(np.uint64) + np.uint64(1)
        h, out = np.zeros((len(x), n), np.uint64), {}
        with np.errstate(over="ignore"):
            for length in range(1, min(n, self.longest) + 1):
                m = n - length + 1
                h = h[:, :m] * BASE + x[:, length - 1 :]
                found = self.find(h)
                for j in np.flatnonzero((found < len(self.pieces)).any(0)).tolist():
                    out[j, j + length] = found[:, j]
        return out

    def forward(self, arcs: dict, n: int, rows: int, scores: np.ndarray) -> np.ndarray:
        a = np.full((n + 1, rows), -np.inf)
        a[0] = 0
        for j, i in sorted(arcs):
            a[i] = np.logaddexp(a[i], a[j] + scores[arcs[j, i]])
        return a

    def groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length together: their numbers and their bytes, each after MARK."""
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, cuts):
            n = int(lengths[group[0]]) + 1
            for at in range(0, len(group), max(1, (1 << 20) // (n * 8))):
                part = group[at : at + max(1, (1 << 20) // (n * 8))]
                yield part, np.frombuffer(b"".join([MARK + words[i] for i in part]), np.uint8).reshape(len(part), n)

    def log_likelihood(self, words: list[bytes], log_p: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability, over all its segmentations."""
        scores, out = np.append(log_p, -np.inf), np.zeros(len(words))
        for part, x in self.groups(words) if words else ():
            n = x.shape[1]
            if n <= LONG:
                out[part] = self.forward(self.arcs(x), n, len(part), scores)[n]
            else:
                for k, row in zip(part, x, strict=True):
                    out[k] = self._one(row, scores)
        return out

    def _one(self, x: np.ndarray, scores: np.ndarray) -> float:
        """The same for one long word, place by place."""
        n = len(x)
        a = np.full(n + 1, -np.inf)
        a[0] = 0.0
        step = 1 << 16
        for lo in range(0, n, step):  # the arcs into the places lo + 1 .. hi
            hi = min(n, lo + step)
            first = max(0, lo - self.longest)
            into: list[list[tuple[int, float]]] = [[] for _ in range(hi - lo)]
            y = x[first:hi].astype(np.uint64) + np.uint64(1)
            h = np.zeros(len(y), np.uint64)
            with np.errstate(over="ignore"):
                for length in range(1, min(len(y), self.longest) + 1):
                    h = h[: len(y) - length + 1] * BASE + y[length - 1 :]
                    found = self.find(h)
                    for j in np.flatnonzero(found < len(self.pieces)).tolist():
                        if (end := first + j + length) > lo:
                            into[end - lo - 1].append((first + j, float(scores[found[j]])))
            for i, arcs in enumerate(into, lo + 1):
                terms = [a[j] + s for j, s in arcs]
                top = max(terms)
                a[i] = top + math.log(sum([math.exp(t - top) for t in terms]))
        return float(a[n])


@cache
def lattice(path: str) -> Lattice:
    """One for each Python worker."""
    return Lattice(path)


def word_counts(docs: DataFrame, flush: int = 200_000) -> DataFrame:
    """docs: text, train (boolean). Every word of any text with its number in training texts: word (binary), c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, others = Counter(), set()

        def out() -> pa.RecordBatch:
            others.difference_update(counts)
            words, n = [*counts, *others], [*counts.values(), *([0] * len(others))]
            counts.clear(), others.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "c"])

        for b in slices(batches, "text", 1 << 20):
            for t, train in zip(text_bytes(b.column("text")), b.column("train").to_pylist(), strict=True):
                (counts if train else others).update(t.lower().split())
            if len(counts) + len(others) > flush:
                yield out()
        if counts or others:
            yield out()

    return docs.select("text", "train").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score_texts(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, hot: int = 150_000) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score.

    Tokens are the words, A-Z lower-cased, and one end for each text; null and blank texts have the end alone. Rows whose
    crc32(doc_id) mod `folds` is `held_out` aren't learned from; a null id counts as the empty text there.
    base_score: log10 likelihood of unigrams with half a count added.
    lattice_score: log10 of the product over the words of L, the sum over all segmentations into the vocabulary's pieces.
    score: log10 probability of the text, where a word's lattice has the pieces, weighed by u, and, if it is a training word,
    one arc over the whole word: (1 - e) ((1 - u) c / W + u L), and an end e. e: share of ends in the training tokens, W:
    training words, u: the share of training words that are seen once (Good and Turing's estimate for new words). With
    nothing to learn from, u is 1.

    Words of any length and script are scored. Repeated rows count as often as they stand and have equal scores; other
    columns are ignored; an empty table gives an empty result.

    The `hot` most frequent words of 64 bytes at most, a fixed number, go to all tasks; all other words of a text are joined
    with the table of words by a shuffle. Counts are exact, and no word is left out.
    """
    spark = docs.sparkSession
    flag = remainder_of_id(id_col, folds) == held_out
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), flag.alias("held_out"))
    counts = materialize(word_counts(d.withColumn("train", ~F.col("held_out"))), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("w"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()
    ends = d.filter(~F.col("held_out")).count()
    n, v, w = total["w"] + ends, total["v"] + (ends > 0), total["w"]
    u = min(max(total["once"] / w, 1e-4), 0.9) if w else 1.0
    e = (ends + 0.5) / (n + 1)
    bottom = n + 0.5 * (v + 1)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(vocabulary)
        for b in batches:
            c = b.column("c").to_numpy()
            inside = model.log_likelihood(b.column("word").to_pylist(), model.initial)
            with np.errstate(divide="ignore"):
                whole = np.log((1 - u) * c / max(w, 1))
            lp = (np.logaddexp(math.log(u) + inside, whole) + math.log(1 - e)) / math.log(10)
            cols = [b.column("word"), b.column("c"), *map(pa.array, (np.log10((c + 0.5) / bottom), lp, inside / math.log(10)))]
            yield pa.RecordBatch.from_arrays(cols, ["word", "c", "base", "lp", "pieces"])

    table = materialize(counts.mapInArrow(weigh, "word binary, c long, base double, lp double, pieces double"), "weighed")
    top = table.filter(F.length("word") <= 64).orderBy(F.col("c").desc(), "word").limit(hot).toArrow()
    sums = {"n_known": (top["c"].to_numpy() > 0).astype(np.int64), **{name: top[c].to_numpy() for name, c in (("base_score", "base"), ("score", "lp"), ("lattice_score", "pieces"))}}
    shared = spark.sparkContext.broadcast(({x: i for i, x in enumerate(top["word"].to_pylist())}, {k: np.append(x, np.zeros(1, x.dtype)) for k, x in sums.items()}))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = shared.value
        get, none = place.get, len(place)
        for b in slices(batches, "text", 1 << 20):
            words = [t.lower().split() for t in text_bytes(b.column("text"))]
            lengths = np.array([len(x) for x in words])
            flat = [x for y in words for x in y]
            at = np.array([get(x, none) for x in flat], np.int64)
            edges = np.concatenate(([0], np.cumsum(lengths)))
            sum_of = lambda a: (s := np.concatenate((np.zeros(1, a.dtype), np.cumsum(a[at]))))[edges[1:]] - s[edges[:-1]]  # noqa: B023, E731
            cold = np.flatnonzero(at == none)
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(cold, edges).astype(np.int32)), pa.array([flat[i] for i in cold], pa.binary()))
            cols = [b.column("rid"), b.column("doc_id"), b.column("held_out"), pa.array(lengths + 1), *(pa.array(sum_of(a)) for a in values.values()), rest]
            yield pa.RecordBatch.from_arrays(cols, ["rid", "doc_id", "held_out", "n_tokens", *values, "rest"])

    kind = d.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, lattice_score double, rest array<binary>"
    parts = materialize(d.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(split, schema), "parts")
    cold = parts.select("rid", F.explode("rest").alias("word")).join(table, "word")
    cold = cold.groupBy("rid").agg(F.count_if(F.col("c") > 0).alias("k"), F.sum("base").alias("b"), F.sum("lp").alias("l"), F.sum("pieces").alias("p"))
    both = parts.drop("rest").join(cold, "rid", "left")
    end_base, end_score = math.log10((ends + 0.5) / bottom), math.log10(e)
    add = lambda x, y, z: (F.col(x) + F.coalesce(y, F.lit(0)) + F.lit(z)).alias(x)
    return both.select(
        "doc_id", "held_out", "n_tokens", add("n_known", "k", int(ends > 0)), F.lit(n).cast("long").alias("train_tokens"), add("base_score", "b", end_base), add("score", "l", end_score),
        add("lattice_score", "p", 0.0),
    )
