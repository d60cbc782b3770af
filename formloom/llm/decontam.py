"""Benchmark decontamination by latent semantic retrieval.

A distributed randomised SVD of TF-IDF passages gives a latent space; passages of documents near a benchmark passage by
cosine are candidates, which a longest common subsequence with the benchmark item and a check of its answer decide. An
exact path adds what the space misses, however common an item's words are: a region that leaks an item holds a word of its
seeds, so all regions with one are counted word by word and then decided in the same way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize, slices, text_bytes, word_hashes, word_spans

#: A-Z in lower case, all other ASCII but digits and letters as blanks; bytes beyond ASCII belong to words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
IS_WORD = np.array([FOLD[b] != 32 for b in range(256)], np.int8)


@dataclass(frozen=True)
class Settings:
    """bits: of hashed terms. window, step: of passages, in words. rank, extra: of the SVD. sample: the bound on corpus
    passages that the space is fitted on besides the benchmark's. near: least cosine of a candidate. copy: least share of
    an item in common order; loose: the same where the answer is there too. items: benchmark items searched for in one pass
    over the documents, which bounds what goes to each task."""

    bits: int = 18
    window: int = 32
    step: int = 16
    rank: int = 256
    extra: int = 8
    common: float = 0.2
    sample: int = 2048
    near: float = 0.4
    cover: float = 0.4
    copy: float = 0.8
    loose: float = 0.6
    answer: float = 0.8
    short: int = 8
    items: int = 10_000
    seed: int = 42


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def terms(texts: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all texts, one after the other, and where each text's begin and the last ends."""
    buf = np.frombuffer(b" ".join([b"", *(t.translate(FOLD) for t in texts), b""]), np.uint8)
    starts, ends = word_spans(buf, IS_WORD)
    ids = (word_hashes(buf, starts, ends) >> np.uint64(64 - s.bits)).astype(np.int64)
    return ids, np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))


SAMPLED = 16  # classes of passages, of each of which the least are sampled


def least_passages(kept: np.ndarray, s: Settings) -> np.ndarray:
    """Of passages (hash, then s.window terms, as 64-bit integers) the s.sample / SAMPLED with the least hashes, each once."""
    return kept[np.unique(kept[:, 0], return_index=True)[1][: s.sample // SAMPLED]]


def summed(df: DataFrame, kind: str, s: Settings | None = None) -> dict[int, np.ndarray]:
    """Sum of the arrays (`data`, bytes of numpy's `kind`) of each `block`; one row for each block reaches the driver.
    Blocks from -2 downwards are passages, of which the least stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                own = np.frombuffer(x, kind)
                if k not in total:
                    total[k] = own
                elif k < -1:
                    total[k] = least_passages(np.concatenate((total[k], own)).reshape(-1, s.window + 1), s).reshape(-1)
                else:
                    total[k] = total[k] + own
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["block", "data"])

    rows = df.repartition("block").mapInArrow(run, "block int, data binary").collect()
    return {r["block"]: np.frombuffer(r["data"], kind) for r in rows}


def passages_of(ids: np.ndarray, at: np.ndarray, s: Settings) -> np.ndarray:
    """The passages of some texts as rows: a hash of the terms, and the terms, -1 beyond the end."""
    n = np.diff(at)
    some = np.maximum(1, -(-(n - s.window) // s.step) + 1) * (n > 0)
    text = np.repeat(np.arange(len(n)), some)
    start = at[text] + s.step * (np.arange(len(text)) - np.repeat(np.cumsum(some) - some, some))
    place = start[:, None] + np.arange(s.window)
    terms_ = np.where(place < at[text + 1][:, None], ids[np.minimum(place, max(len(ids) - 1, 0))], -1)
    with np.errstate(over="ignore"):
        h = ((terms_ + 2).astype(np.uint64) * np.cumprod(np.full(s.window, 0x9E3779B97F4A7C15, np.uint64))).sum(1, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)
    return np.column_stack((h.astype(np.int64), terms_))


def document_frequencies(docs: DataFrame, s: Settings, blocks: int = 64) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """In how many of all documents each term is, the number of documents, and s.sample passages at most, from one pass.

    Passages are sampled by a hash of their terms, s.sample / SAMPLED of each class of hashes; each is s.window terms, so
    what reaches the driver is bounded however long a text is.
    """
    size = (1 << s.bits) // blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << s.bits, np.int64), 0
        kept = [np.zeros((0, s.window + 1), np.int64)] * SAMPLED
        for b in slices(batches, "text"):
            ids, at = terms(text_bytes(b.column("text")), s)
            doc = np.repeat(np.arange(b.num_rows), np.diff(at))
            df += np.bincount(np.unique(ids * b.num_rows + doc) // max(b.num_rows, 1), minlength=len(df))
            n += b.num_rows
            own = passages_of(ids, at, s)
            kept = [least_passages(np.concatenate((k, own[own[:, 0] % SAMPLED == c])), s) for c, k in enumerate(kept)]
        data = [df[i * size : (i + 1) * size].tobytes() for i in range(blocks)] + [np.array([n]).tobytes()] + [k.tobytes() for k in kept]
        yield pa.RecordBatch.from_arrays([pa.array([*range(blocks), -1, *range(-2, -2 - SAMPLED, -1)], pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

    found = summed(docs.select("text").mapInArrow(run, "block int, data binary"), "<i8", s)
    if not found:
        return np.zeros(1 << s.bits, np.int64), 0, []
    sampled = [p[p >= 0] for k in range(-2, -2 - SAMPLED, -1) for p in least_passages(found[k].reshape(-1, s.window + 1), s)[:, 1:]]
    return np.concatenate([found[i] for i in range(blocks)]), int(found[-1][0]), sampled


def windows(n: int, s: Settings) -> list[tuple[int, int]]:
    """The passages of n words: `window` words each, a new one every `step` words, up to the end."""
    return [(i, min(n, i + s.window)) for i in range(0, max(1, n - s.window + s.step), s.step)] if n else []


def latent_space(passages: list[tuple[np.ndarray, np.ndarray]], size: int, docs: DataFrame, s: Settings) -> np.ndarray:
    """Right singular vectors (size x rank) of the matrix whose rows are the passages (terms, weights).

    Randomised range finder with one power step, then Rayleigh and Ritz. Each product with the matrix and its transpose is
    a job whose tasks hold a share of the rows; the partial products are summed by blocks of terms.
    """
    spark = docs.sparkSession
    rank = min(s.rank + s.extra, len(passages), size)
    rows = spark.createDataFrame([(ids.astype("<i4").tobytes(), w.astype("<f4").tobytes()) for ids, w in passages], "ids binary, weights binary").repartition(min(4, max(1, len(passages) // 64)))
    block = 4096

    def gram(q: np.ndarray) -> np.ndarray:
        given = spark.sparkContext.broadcast(q.astype(np.float32))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, right = np.zeros(given.value.shape, np.float64), given.value
            for b in batches:
                for i, w in zip(b.column("ids").to_pylist(), b.column("weights").to_pylist(), strict=True):
                    ids, w = np.frombuffer(i, "<i4"), np.frombuffer(w, "<f4")
                    out[ids] += np.outer(w, w @ right[ids])
            parts = range(0, len(out), block)
            yield pa.RecordBatch.from_arrays([pa.array([p // block for p in parts], pa.int32()), pa.array([out[p : p + block].tobytes() for p in parts], pa.binary())], ["block", "data"])

        found = summed(rows.mapInArrow(run, "block int, data binary"), "<f8")
        return np.concatenate([found[k] for k in sorted(found)]).reshape(q.shape)

    q, _ = np.linalg.qr(gram(np.random.default_rng(s.seed).normal(size=(size, rank))))
    power = gram(q)
    values, turn = np.linalg.eigh(q.T @ power)
    return (q @ turn[:, np.argsort(-values)[: s.rank]]).astype(np.float32)


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if m := masks.get(w):
            x = v & m
            v = (v + x | v - x) & full
    return len(a) - v.bit_count()


def verify(item: list[bytes], answer: list[bytes], region: list[bytes], s: Settings) -> tuple[bool, float, bool]:
    """Whether a region of a document leaks an item, with the share of it in common order and whether the answer is there.

    Items of fewer than s.short words leak only as they stand, word by word."""
    if len(item) < s.short:
        n = len(item)
        same = any(region[i : i + n] == item for i in range(len(region) - n + 1))
        return same, float(same), same
    share = common_subsequence(item, region) / len(item)
    there = bool(answer) and common_subsequence(answer, region) / len(answer) >= s.answer
    return share >= s.copy or share >= s.loose and there, share, there


def least(n: int, share: float) -> int:
    """The fewest of n words that are the share of them."""
    return next(c for c in range(n + 1) if c / n >= share)


def seeds(item: np.ndarray, answer: np.ndarray, df: np.ndarray, s: Settings) -> np.ndarray:
    """Terms of which any region that verify() accepts holds one.

    With c of n words in common, n - c + 1 places can't all be without; those of the rarest terms are taken. A loose copy
    must have its share of the item and of the answer, so the rarer of both will do.
    """

    def rarest(t: np.ndarray, share: float) -> np.ndarray:
        return np.unique(t[np.argsort(df[t], kind="stable")[: len(t) - least(len(t), share) + 1]])

    if len(item) < s.short:
        return rarest(item, 1.0)
    found = [rarest(item, s.copy)]
    if len(answer):
        found.append(min(rarest(item, s.loose), rarest(answer, s.answer), key=lambda t: df[t].sum()))
    return np.unique(np.concatenate(found))


class Search:
    """What a task needs to find leaks of some benchmark items: bounded by their number and the space's rank."""

    def __init__(self, items: list[tuple[int, list[bytes], list[bytes]]], row_of: np.ndarray, idf: np.ndarray, space: np.ndarray, queries: np.ndarray, size: np.ndarray, item_of: np.ndarray, seeds_of: list[np.ndarray], s: Settings):
        self.items, self.row_of, self.idf, self.space, self.queries, self.size, self.item_of, self.s = items, row_of, idf, space, queries, size, item_of, s
        self.counts = [Counter(w) for _, w, _ in items]
        self.answers = [Counter(a) for *_, a in items]
        self.sets = [frozenset((*w, *a)) for _, w, a in items]
        # the items of each seed, one seed after the other
        seed, item = np.concatenate(seeds_of), np.repeat(np.arange(len(items)), [len(x) for x in seeds_of])
        order = np.argsort(seed, kind="stable")
        self.seed_items = item[order]
        own, self.seed_first, self.seed_times = np.unique(seed[order], return_index=True, return_counts=True)
        self.seed_row = np.full(1 << s.bits, -1, np.int32)
        self.seed_row[own] = np.arange(len(own))
        # a window's dot product with query q is the sum of its terms' idf * (space @ q); this is each term's most of s.cover * size
        share, scaled = np.zeros(len(space)), queries / size[:, None]
        for lo in range(0, len(scaled), 256):  # 256 queries at once: 80 MB for 40,000 terms, whatever the number of items
            np.maximum(share, (space.astype(np.float64) @ scaled[lo : lo + 256].T).max(1, initial=0.0), out=share)
        used = np.flatnonzero(row_of >= 0)
        self.reach = np.zeros(len(space))
        self.reach[row_of[used]] = share[row_of[used]] * idf[used]
        self.weighted = np.zeros_like(space)
        self.weighted[row_of[used]] = space[row_of[used]] * idf[used][:, None]

    def candidates(self, ids: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(text, item, first word, cosine) of each window near a benchmark passage; ids and at: the texts' terms."""
        s = self.s
        if not len(ids) or not len(self.queries):
            return []
        n = np.diff(at)
        steps = -(-n // s.step)  # parts of `step` words, of which a window has window / step
        first = np.concatenate(([0], np.cumsum(steps)))
        row = self.row_of[ids]
        here = np.flatnonzero(row >= 0)
        if not len(here):
            return []
        doc = np.searchsorted(at, here, side="right") - 1
        part = first[doc] + (here - at[doc]) // s.step
        spans, total = s.window // s.step, int(first[-1])
        owner = np.repeat(np.arange(len(n)), steps)
        start = np.arange(total)
        # no query can be near a window whose terms can't reach s.cover together; parts that no other window needs are skipped
        reach = np.bincount(part, self.reach[row[here]], total + spans)
        inside = [start + k < first[owner + 1] for k in range(spans)]  # parts of the next text don't belong to a window
        most = sum(np.where(inside[k], reach[k : total + k], 0) for k in range(spans))
        some = np.flatnonzero(most >= 0.999 * s.cover)
        if not len(some):
            return []
        wanted = np.zeros(total + spans, bool)
        for k in range(spans):
            wanted[some + k] = True
        chosen = np.flatnonzero(wanted[part])
        here, part = here[chosen], part[chosen]
        begin = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        place = np.full(total + spans, -1)
        place[part[begin]] = np.arange(len(begin))
        sums = np.vstack((np.add.reduceat(self.weighted[row[here]], begin), np.zeros((1, self.space.shape[1]), np.float32)))
        w = sums[place[some]]
        for k in range(1, spans):
            w += sums[np.where(inside[k][some], place[some + k], -1)]
        norm = np.sqrt((w * w).sum(1))
        out, rows = [], max(1, (4 << 20) // len(self.queries))
        for lo in range(0, len(some), rows):  # windows by queries, about four million products at once
            dot = w[lo : lo + rows] @ self.queries.T
            near = (norm[lo : lo + rows] > 1e-6)[:, None] & (dot >= s.near * norm[lo : lo + rows, None]) & (dot >= s.cover * self.size)
            for i, q in zip(*np.nonzero(near), strict=True):
                k = some[lo + i]
                out.append((int(owner[k]), int(self.item_of[q]), int(start[k] - first[owner[k]]) * s.step, float(dot[i, q] / norm[lo + i])))
        return out

    def seeded(self, ids: np.ndarray, at: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item, places of words) of each text with seeds of an item; about `limit` places are held at once."""
        row = self.seed_row[ids]
        here = np.flatnonzero(row >= 0)
        if not len(here):
            return
        row = row[here]
        doc = np.searchsorted(at, here, side="right") - 1
        times = self.seed_times[row]
        share = (np.cumsum(np.bincount(doc, times, len(at) - 1)) // limit)[doc]
        for k in np.unique(share):
            some = np.flatnonzero(share == k)
            n = times[some]
            item = self.seed_items[np.repeat(self.seed_first[row[some]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            d, place = np.repeat(doc[some], n), np.repeat(here[some] - at[doc[some]], n)
            order = np.lexsort((place, item, d))
            d, item, place = d[order], item[order], place[order]
            cut = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (item[1:] != item[:-1]), [True])))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                yield int(d[a]), int(item[a]), place[a:b]

    def can_leak(self, i: int, region: list[bytes]) -> bool:
        """Whether a region has enough of an item's words, in any order. Each counts as often as the item has it."""
        s, n = self.s, len(self.items[i][1])
        if n < s.short:
            return True
        there = self.sets[i].intersection(region)
        some = sum(c for w, c in self.counts[i].items() if w in there)
        if some >= s.copy * n - 1e-9:
            return True
        answer = self.answers[i]
        return some >= s.loose * n - 1e-9 and bool(answer) and sum(c for w, c in answer.items() if w in there) >= s.answer * answer.total() - 1e-9

    def verified(self, i: int, words: list[bytes], lo: int) -> tuple[bool, float, bool]:
        """verify() of an item and the region about the window at lo."""
        _, item, answer = self.items[i]
        region = words[max(0, lo - len(item)) : lo + self.s.window + len(item)]
        if not self.can_leak(i, region):
            return False, 0.0, False
        own = self.sets[i]
        return verify(item, answer, [w for w in region if w in own] if len(item) >= self.s.short else region, self.s)

    def cosine(self, i: int, ids: np.ndarray) -> float:
        """Cosine of a window's terms with the nearest passage of an item; 0 if they have no weight."""
        row = self.row_of[ids]
        w = self.weighted[row[row >= 0]].sum(0)
        norm = float(np.sqrt((w * w).sum()))
        return float((self.queries[self.item_of == i] @ w).max() / norm) if norm > 1e-6 else 0.0

    def near_seeds(self, i: int, words: list[bytes], places: np.ndarray) -> Iterator[int]:
        """First words of the windows whose regions hold one of the places and may leak the item."""
        s, n = self.s, len(self.items[i][1])
        last = len(windows(len(words), s)) - 1
        first = np.maximum(0, -((s.window + n - 1 - places) // s.step))
        stop = np.minimum(last, (places + n) // s.step) + 1
        cut = np.flatnonzero(np.concatenate(([True], first[1:] > stop[:-1])))
        for a, b in zip(first[cut].tolist(), stop[np.append(cut[1:], len(places)) - 1].tolist(), strict=True):
            if self.can_leak(i, words[max(0, a * s.step - n) : (b - 1) * s.step + s.window + n]):
                yield from range(a * s.step, b * s.step, s.step)

    def leaks(self, texts: list[bytes]) -> list[tuple[int, int, float, float, bool]]:
        """(text, item id, cosine, share, answer found) of each item that a text leaks, at its best window."""
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        words: dict[int, list[bytes]] = {}
        ids, at = terms(texts, self.s)
        for d, i, lo, cos in self.candidates(ids, at):
            if d not in words:
                words[d] = words_of(texts[d])
            leak, share, there = self.verified(i, words[d], lo)
            if leak and (cos, share, there) > best.get((d, i), (-1.0, 0.0, False)):
                best[d, i] = (cos, share, there)
        known = set(best)
        for d, i, places in self.seeded(ids, at):
            if (d, i) in known:
                continue
            if d not in words:
                words[d] = words_of(texts[d])
            for lo in self.near_seeds(i, words[d], places):
                leak, share, there = self.verified(i, words[d], lo)
                if leak:
                    cos = self.cosine(i, ids[at[d] + lo : min(at[d] + lo + self.s.window, at[d + 1])])
                    best[d, i] = max(best.get((d, i), (-1.0, 0.0, False)), (cos, share, there))
        return [(d, self.items[i][0], *found) for (d, i), found in best.items()]


def searches(docs: DataFrame, benchmark: DataFrame, s: Settings, *, answer_col: str | None = None) -> Iterator[Search]:
    """A Search for each s.items items of the benchmark, which is the stated query set.

    Items without words leak nowhere. The answer is answer_col, or else an item's last sentence.
    """
    d = docs.select("text")
    df, n, corpus = document_frequencies(d, s)
    idf = np.where(df > s.common * n, 0, np.log((n + 1) / (df + 1))).astype(np.float32)
    columns = ["item_id", "text", *([answer_col] if answer_col else [])]
    ordered = materialize(benchmark.select(*columns).dropna(subset=["text"]), "benchmark")
    count = ordered.count()
    blocks = max(1, -(-count // s.items))
    for k in range(blocks):
        rows = (ordered if blocks == 1 else ordered.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)).collect()
        items, passages, item_of, seeds_of = [], [], [], []
        for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"])):
            words = words_of(r["text"].encode())
            if not words:
                continue
            sentences = [x for x in re.split(r"[.!?\n]+", r["text"]) if words_of(x.encode())]
            answer = words_of((r[answer_col] or "").encode()) if answer_col else words_of(sentences[-1].encode())
            own, _ = terms([r["text"].encode()], s)
            for x, y in windows(len(own), s):
                passages.append(own[x:y])
                item_of.append(len(items))
            items.append((r["item_id"], words, answer))
            seeds_of.append(seeds(own, terms([b" ".join(answer)], s)[0], df, s))
        if not items:
            continue

        def weights(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
            t, c = np.unique(p, return_counts=True)
            w = c * idf[t]
            size = float(np.sqrt((w * w).sum()))
            return t[w > 0], w[w > 0] / max(size, 1e-9), size

        # without weight in any benchmark passage a term can't make a window near one
        used = np.unique(np.concatenate(passages))
        used = used[idf[used] > 0]
        row_of = np.full(1 << s.bits, -1, np.int32)
        row_of[used] = np.arange(len(used))
        own = [(row_of[t], w, z) for t, w, z in map(weights, passages)]
        around = [(row_of[t][row_of[t] >= 0], 0.3 * w[row_of[t] >= 0]) for t, w, _ in map(weights, corpus)]
        given = [(t, w) for t, w, _ in own] + [x for x in around if len(x[0])]
        space = latent_space(given, len(used), docs, s) if len(used) else np.zeros((0, 1), np.float32)  # all terms are common ones
        queries = np.stack([w @ space[t] for t, w, _ in own]).astype(np.float32)
        held = np.sqrt((queries * queries).sum(1))
        size = (np.array([z for *_, z in own]) * held).astype(np.float32)  # the weight that a full copy has along the query
        queries /= np.maximum(held, 1e-9)[:, None]
        queries[held < 1e-6] = 0
        size[held < 1e-6] = np.inf
        yield Search(items, row_of, idf, space, queries, size, np.array(item_of), seeds_of, s)


def contamination(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text", answer_col: str | None = None) -> DataFrame:  # noqa: B008  frozen
    """A row for each row of docs and item that it leaks: doc_id, item_id, cosine, share, answer_found.

    All whole texts are searched, long ones in slices of windows like short ones. Null and empty texts leak nothing;
    repeated rows are reported each; equal items are reported each, and items of any type of id; an empty benchmark or table
    gives an empty result. Other columns are ignored.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = d.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, cosine double, share double, answer_found boolean"
    item_kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    out = docs.sparkSession.createDataFrame([], schema)
    for search in searches(d, benchmark, s, answer_col=answer_col):
        shared = docs.sparkSession.sparkContext.broadcast(search)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text", 1 << 20):
                rows = shared.value.leaks(text_bytes(b.column("text")))
                at, item, *rest = zip(*rows, strict=True) if rows else ([],) * 5
                cols = [b.column("doc_id").take(pa.array(at, pa.int32())), pa.array(item, item_kind), *(pa.array(x, t) for x, t in zip(rest, (pa.float64(), pa.float64(), pa.bool_()), strict=True))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "cosine", "share", "answer_found"])

        out = out.unionAll(d.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), *, text_col: str = "text") -> DataFrame:  # noqa: B008  frozen
    """The rows of docs, with all their columns whatever their names, that leak no item of the benchmark; null texts stay."""
    out = docs
    for search in searches(docs.select(F.col(text_col).alias("text")), benchmark, s):
        shared = docs.sparkSession.sparkContext.broadcast(search)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, text_col, 1 << 20):
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in shared.value.leaks(text_bytes(b.column(text_col)))]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
