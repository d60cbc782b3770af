"""Token ids in files of fixed-width packed bits, with block offsets for random access.

A shard file, little-endian throughout:
    magic `FLTP`, version u16, bits u16, ids u64, documents u64, ids a block u32, blocks u32,
    block offsets u64 x (blocks + 1), from the start of the packed part,
    document starts u64 x (documents + 1), in ids, document ids i64 x documents, validity u8 x documents,
    the packed part: each block's ids, `bits` bits each, least bit first, padded to a byte.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, shared_path, slices
from .token_counts import byte_letters

MAGIC, HEAD, BLOCK = b"FLTP", struct.Struct("<4sHHQQII"), 4096
#: Fixed value: the split of word_bpe_49k.json, after lower-casing.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Stands after each word's ids while words are looked up; no vocabulary has it.
NO_ID = 0xFFFFFFFF
WORD_END = struct.pack("<I", NO_ID)
#: A letter of the Latin-1 block, in UTF-8.
LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
#: The same split in lower-case bytes, but that a word with bytes beyond ASCII and these letters stays whole;
#: a line feed, which ends each word here, is a part.
PARTS = rb"[^\s\x80-\xff]*+(?:LATIN[^\s\x80-\xff]*+)*+[\x80-\xff]\S*|'(?:s|t|re|ve|m|ll|d)|[a-z]+(?:LATIN[a-z]*)*|(?:LATIN[a-z]*)+|[0-9]|[^a-z0-9\s\x80-\xff]+|\n".replace(b"LATIN", LATIN)
#: A piece of such letters.
PLAIN = rb"(?:[a-z]|LATIN)+".replace(b"LATIN", LATIN)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids (unsigned, below 2**bits) in `bits` bits each, least bit first; whole bytes are moved as such."""
    if bits % 8 == 0:
        return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8]).tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(planes.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    """The first n ids of packed data."""
    raw = np.frombuffer(data, np.uint8)
    if bits % 8 == 0:
        out = np.zeros((n, 4), np.uint8)
        out[:, : bits // 8] = raw[: n * bits // 8].reshape(n, bits // 8)
        return out.view("<u4").reshape(-1)
    planes = np.zeros((n, 32), np.uint8)
    planes[:, :bits] = np.unpackbits(raw, bitorder="little", count=n * bits).reshape(n, bits)
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").reshape(-1)


def shard_bytes(docs: list[tuple[int | None, bytes]], bits: int, block: int = BLOCK) -> bytes:
    """The file of some documents, each with its ids as 32-bit integers."""
    lengths = np.array([len(x) // 4 for _, x in docs], np.uint64)
    starts = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lengths)))
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = HEAD.pack(MAGIC, 1, bits, len(ids), len(docs), block, len(blocks))
    names = np.array([d or 0 for d, _ in docs], "<i8")
    valid = np.array([d is not None for d, _ in docs], np.uint8)
    return b"".join((head, offsets.tobytes(), starts.astype("<u8").tobytes(), names.tobytes(), valid.tobytes(), *blocks))


class Shard:
    """A shard file's bytes: all documents, or any span of ids without unpacking the rest."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.n_ids, self.n_docs, self.block, blocks = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard of packed token ids")
        at = HEAD.size
        take = lambda n, kind: np.frombuffer(data, kind, n, at)
        self.offsets = take(blocks + 1, "<u8").astype(np.int64)
        at += 8 * (blocks + 1)
        self.starts = take(self.n_docs + 1, "<u8").astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.doc_ids = take(self.n_docs, "<i8")
        at += 8 * self.n_docs
        self.valid = take(self.n_docs, np.uint8).astype(bool)
        self.packed = memoryview(data)[at + self.n_docs :]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids start to stop, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = [unpack(self.packed[self.offsets[i] : self.offsets[i + 1]], min(self.block, self.n_ids - i * self.block), self.bits) for i in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


class Encoder:
    """Ids of texts by the tokenizers library. Distinct words are parted once for each slice; parts are encoded once and remembered.

    Parts are what ASCII white space parts, which holds for tokenizers that drop white space and never join what it parts.
    Where the file has the split of word_bpe_49k.json, ASCII words are parted further into its pieces, of which there are
    far fewer than words. Texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str, memo: int = 50_000):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.memo = TwoGenerations(memo)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        names = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        self.known = first.get("pattern") == {"Regex": SPLIT} and first["behavior"] == "Removed" and first["invert"] and names == ["NFC", "Replace", "Lowercase"]
        self.parts = re.compile(PARTS).findall
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.model, self.letters, self.plain = self.own.model, "".join(byte_letters()), re.compile(PLAIN).fullmatch

    def _ids(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.own.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> None:
        """Ids of parts. Pieces of plain letters and marks need neither normalisation nor a split, so the model has them at once."""
        known, whole, tokenize = self.memo.young, [], self.model.tokenize
        for p in parts:
            if not self.known:
                whole.append(p)
                continue
            word = p.decode()
            if not (word.isascii() and word.isprintable()):
                if not self.plain(p):
                    whole.append(p)
                    continue
                word = word.lower().encode().decode("latin-1").translate(self.letters)
            known[p] = array("I", [t.id for t in tokenize(word)]).tobytes()
        for at in range(0, len(whole), 20_000):
            some = whole[at : at + 20_000]
            known.update(zip(some, self._ids([p.decode() for p in some]), strict=True))

    def _of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's begin in it (and the last one's end)."""
        parts = self.parts(b"\n".join([*words, b""])) if self.known else [x for w in words for x in (w, b"\n")]
        known = self.memo.young
        known[b"\n"] = WORD_END
        found = list(map(known.get, parts))
        if None in found:
            self._learn(self.memo.missing({x for x, v in zip(parts, found, strict=True) if v is None}))
            found = list(map(known.__getitem__, parts))
        ids = np.frombuffer(b"".join(found), "<u4")
        ends = np.flatnonzero(ids == NO_ID)
        self.memo.turn()
        return np.delete(ids, ends), np.concatenate((np.zeros(1, np.int64), ends - np.arange(len(ends))))

    def encode(self, texts: pa.Array, end: int) -> list[bytes]:
        """The ids of each text (null: empty) and then `end`, as little-endian 32-bit integers.

        Each distinct word of the texts is parted and looked up once; numpy then gathers the ids of all words.
        """
        last = np.array([end], "<u4").tobytes()
        texts = texts.cast(pa.string()).fill_null("")
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pa.compute.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = pa.compute.if_else(pa.array(special), "", texts) if special.any() else texts
        split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(plain) if self.known else plain)
        words = split.flatten().dictionary_encode()
        ids, at = self._of_words(words.dictionary.cast(pa.binary()).to_pylist())
        each = words.indices.to_numpy()
        lengths = np.diff(at)[each]
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))
        place = np.arange(upto[-1], dtype=np.int64 if upto[-1] > 1 << 30 else np.int32)
        place += np.repeat((at[:-1][each] - upto[:-1]).astype(place.dtype), lengths)
        all_ids = ids[place]
        bounds = upto[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        out = [all_ids[a:z].tobytes() + last for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in np.flatnonzero(special).tolist():
            out[i] = self._ids([texts[i].as_py()])[0] + last
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_packed(
    docs: DataFrame, tokenizer: str, *, end: int, vocabulary: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = 8 << 20,
) -> tuple[str, DataFrame]:
    """Encode every document, append `end`, and write all ids in ascending doc_id order as shard files.

    Returns the folder and the manifest (shard, file, n_docs, n_ids, base: the ids in all shards before), whose rows are
    as many as the shards. vocabulary: the number of ids; its bits are the width. A null text is encoded as empty; a null
    doc_id comes first; rows with one doc_id, repeated ones too, follow each other in the order of their texts' hashes.
    Other columns are ignored; an empty table has no shards.

    A task has a range of the sorted documents and begins a new file after `shard_ids` ids, 32 MB as they are held, or a
    document that is longer; so neither a task's memory nor a file's size depends on the number of partitions. A file's name
    has the number of the attempt that wrote it and only finished attempts are in the manifest: a task that is run again or
    twice at once leaves files that nothing reads.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "packed")
    bits = max(1, (max(vocabulary, end + 1) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoder(tokenizer), TaskContext.get()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        rows, held, k = [], 0, 0

        def shard() -> pa.RecordBatch:
            name = f"shard-{task.partitionId():06d}-{k:05d}-{task.taskAttemptId()}.fltp"
            with store.open_output_stream(f"{folder}/{name}") as f:
                f.write(shard_bytes(rows, bits))
            columns = {"part": pa.array([task.partitionId()], pa.int32()), "k": pa.array([k], pa.int32()), "file": [name], "n_docs": [len(rows)], "n_ids": [held // 4]}
            return pa.RecordBatch.from_pydict(columns)

        for b in slices(batches, "text", 4 << 20):
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), own.encode(b.column("text"), end), strict=True):
                rows.append((doc_id, ids))
                held += len(ids)
                if held >= 4 * shard_ids:
                    yield shard()
                    rows, held, k = [], 0, k + 1
            pa.default_memory_pool().release_unused()
        if rows:
            yield shard()

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).drop("h")
    rows = ordered.mapInArrow(run, "part int, k int, file string, n_docs long, n_ids long").collect()  # one row for each shard
    base, out = 0, []
    for i, r in enumerate(sorted(rows, key=lambda r: (r["part"], r["k"]))):
        out.append((i, r["file"], r["n_docs"], r["n_ids"], base))
        base += r["n_ids"]
    return path, spark.createDataFrame(out, "shard int, file string, n_docs long, n_ids long, base long").coalesce(1)


def read_packed(path: str, manifest: DataFrame) -> DataFrame:
    """Read the shards of a folder back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), one row for each document. Each shard is one task, with one shard in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for b in batches:
            for name, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                with store.open_input_file(f"{folder}/{name}") as f:
                    shard = Shard(f.read())
                ids = shard.ids(0, shard.n_ids)
                starts = shard.starts
                crc = [zlib.crc32(ids[a:z]) for a, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                cols = [pa.array(shard.doc_ids, mask=~shard.valid), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = manifest.count()
    spread = manifest.repartition(max(1, n), "shard") if n else manifest
    return spread.select("file", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
