"""Token counts: a prefix dynamic programme gives the exact token count of every prefix of a text.

The counts are those of a byte-level BPE of the tokenizers library. They answer how many tokens a text has, where a text
must be cut to fit a budget, and how many tokens any prefix has, without encoding anything again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import accumulate, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, slices

#: Fixed value: the split of byte-level BPE, as the library's pre-tokenizer has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Contractions of three bytes; their first two bytes alone are two pieces.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
#: Texts whose characters are all below this one are split by the faster of two equal patterns.
PLAIN = "ƀ"


def _plain_pattern() -> str:
    """PATTERN for characters below PLAIN, with its classes spelled out for the `re` module."""
    low = [chr(i) for i in range(ord(PLAIN))]
    letters = "".join(c for c in low if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in low if unicodedata.category(c)[0] == "N")
    spaces = re.escape("\t\n\x0b\x0c\r \x85\xa0")
    other = f"[^{spaces}{letters}{numbers}]"
    return f"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?{other}+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class PrefixCounter:
    """Counts of all prefixes of texts under the byte-level BPE in the file `path`."""

    def __init__(self, path: str, memo: int = 300_000):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        if spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"]:
            raise ValueError(f"{path} isn't a plain byte-level BPE")
        self.model = Tokenizer.from_file(path).model
        vocab = spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.tokens = ahocorasick.Automaton()
        for t in vocab:
            if t not in self.specials:
                self.tokens.add_word(t, t)
        self.tokens.make_automaton()
        self.letters = byte_letters()
        self.plain, self.full = re.compile(_plain_pattern()), regex.compile(PATTERN)
        self.beyond = re.compile(f"[^\x00-{chr(ord(PLAIN) - 1)}]")
        self.runs = regex.compile(r"\s{2,}")
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.memo, self.follows = TwoGenerations(memo), {}

    def _may_follow(self, pair: tuple[str, str]) -> bool:
        """Whether the BPE of the two tokens' letters is these two tokens; with the first empty, the second alone."""
        if len(self.follows) > 2_000_000:
            self.follows.clear()
        known = self.follows[pair] = [t.value for t in self.model.tokenize(pair[0] + pair[1])] == [t for t in pair if t]
        return known

    def _increments(self, pieces: set[str]) -> None:
        """Fill the memo for pieces: for each character by how much the count of the prefix that ends with it differs.

        A sequence of tokens is the BPE of its letters if and only if each two neighbours are. So the last token of a
        prefix is the one token that may follow the last token of the rest, and count(prefix) = count(rest) + 1. The
        automaton names the tokens that end at each letter, the longest first.
        """
        follows, may, young, tokens = self.follows, self._may_follow, self.memo.young, self.tokens.iter
        code = self.letters.__getitem__
        for piece in pieces:
            raw = piece.encode()
            counts, lasts = [0], [""]
            at = -1
            for end, token in tokens("".join(map(code, raw))):
                if end == at:
                    continue  # the prefix has its last token
                start = end + 1 - len(token)
                pair = (lasts[start], token)
                known = follows.get(pair)
                if may(pair) if known is None else known:
                    counts.append(counts[start] + 1)
                    lasts.append(token)
                    at = end
            if len(counts) != len(raw) + 1:
                raise ValueError(f"no tokens for all prefixes of {piece!r}")
            if len(raw) != len(piece):
                ends = accumulate([len(c.encode()) for c in piece])
                counts = [0, *(counts[e] for e in ends)]
            if piece in LONG_CONTRACTIONS:
                counts[2] = 2
            young[piece] = bytes([y - x & 255 for x, y in pairwise(counts)])

    def _split(self, text: str) -> list[str]:
        return (self.full if self.beyond.search(text) else self.plain).findall(text)

    def _ordinary(self, text: str, pieces: list[str]) -> np.ndarray:
        """Counts of the prefixes of 1, 2, ... characters of a text without special tokens."""
        counts = np.cumsum(np.frombuffer(b"".join(map(self.memo.young.__getitem__, pieces)), np.int8), dtype=np.int32)
        for m in self.runs.finditer(text):
            a, b = m.span()
            if b < len(text):  # cut there, the run is one piece, whose last blank doesn't join what follows
                self.learn({m[0]})
                counts[b - 1] = (counts[a - 1] if a else 0) + int(np.frombuffer(self.memo.young[m[0]], np.int8).sum())
        return counts

    def learn(self, pieces: set[str]) -> None:
        if missing := self.memo.missing(pieces):
            self._increments(missing)

    def tables(self, texts: Sequence[str]) -> list[np.ndarray]:
        """For each text the exact token count of each of its prefixes, by characters."""
        special = [bool(self.special and self.special.search(t)) for t in texts]
        split = [[] if s else self._split(t) for t, s in zip(texts, special, strict=True)]
        known, unknown = self.memo.young.get, set()
        for pieces in split:
            if None in (found := list(map(known, pieces))):
                unknown.update([p for p, v in zip(pieces, found, strict=True) if v is None])
        self.learn(unknown)
        out = [self._ordinary(t, p) if not s else None for t, p, s in zip(texts, split, special, strict=True)]
        self.memo.turn()
        return [self._with_specials(t) if s else c for t, c, s in zip(texts, out, special, strict=True)]

    def _with_specials(self, text: str) -> np.ndarray:
        out, base, at = [], 0, 0
        for m in [*self.special.finditer(text), None]:
            cut = text[at : m.end() - 1 if m else len(text)]  # a special token cut short is ordinary text
            pieces = self._split(cut)
            self.learn(set(pieces))
            counts = self._ordinary(cut, pieces) + base
            out.append(counts)
            if m:
                before = m.start() - at
                base = (int(counts[before - 1]) if before else base) + 1
                out.append(np.array([base], np.int32))
                at = m.end()
        return np.concatenate(out)


@cache
def counter(path: str) -> PrefixCounter:
    """One for each Python worker."""
    return PrefixCounter(path)


def packed(counts: np.ndarray) -> bytes:
    """A table as it is stored: for each character by how much the count differs from the one before, in 8 bits where all
    differences fit, else in 32."""
    steps = np.diff(counts, prepend=0)
    small = steps.astype(np.int8)
    return small.tobytes() if np.array_equal(small, steps) else steps.astype("<i4").tobytes()


def unpacked(table: bytes, n_chars: int) -> np.ndarray:
    """The counts of the prefixes of 1, 2, ... n_chars characters from a stored table."""
    return np.cumsum(np.frombuffer(table, np.int8 if len(table) == n_chars else "<i4"), dtype=np.int64)


def tokens_of_prefix(table: bytes, n_chars: int, characters: int) -> int:
    """Token count of the prefix of that many characters, from a stored table."""
    return int(unpacked(table, n_chars)[characters - 1]) if characters else 0


def longest_prefix(table: bytes, n_chars: int, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens, from a stored table."""
    fits = np.flatnonzero(unpacked(table, n_chars) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_tables(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes (UTF-8), n_chars and prefix_steps, the exact count at every prefix.

    See unpacked(), tokens_of_prefix() and longest_prefix() for what prefix_steps answers. Counts are exactly the
    library's, without added special tokens; strings of special tokens in a text are those tokens, as is the library's
    default. A null text counts as empty, whose table is empty; texts of any length have a table of all their characters,
    and repeated rows one each. Other columns are ignored, whatever their names; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for b in slices(batches, "text"):
            texts = ["" if t is None else t for t in b.column("text").to_pylist()]
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([len(t) for t in texts], pa.int64())
            tables = pa.array([packed(c) for c in own.tables(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *sizes, tables], ["doc_id", "n_bytes", "n_chars", "prefix_steps"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_chars long, prefix_steps binary")


def budget_counts(tables: DataFrame, *, budget: int = 512) -> DataFrame:
    """Answers from the rows of prefix_tables() alone: doc_id, n_bytes, n_tokens and n_fit, the characters of the longest
    prefix of at most `budget` tokens. An empty text has 0 of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "prefix_steps"):
            tokens, fit = [], []
            for n, table in zip(b.column("n_chars").to_pylist(), b.column("prefix_steps").to_pylist(), strict=True):
                counts = unpacked(table, n)
                fits = np.flatnonzero(counts <= budget)
                tokens.append(int(counts[-1]) if n else 0)
                fit.append(int(fits[-1]) + 1 if len(fits) else 0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(tokens, pa.int64()), pa.array(fit, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "n_fit"])

    kind = tables.schema["doc_id"].dataType.simpleString()
    return tables.select("doc_id", "n_bytes", "n_chars", "prefix_steps").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, n_fit long")
