"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates how often each is right."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PRIME, WORD_SEPARATORS, materialize, slices, text_bytes, word_hashes, word_spans

IS_WORD = np.array([b not in WORD_SEPARATORS for b in range(256)], np.int8)
#: The symbols that the contract counts.
SYMBOLS = b"#*$%&|<>"
#: Bytes that are no code point of a word: separators and those that continue a code point.
NOT_COUNTED = bytes([*WORD_SEPARATORS, *range(0x80, 0xC0)])
UPPER = np.array([65 <= b <= 90 for b in range(256)], np.int8)
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80 for b in range(256)], np.int8)
ODD = np.array([b in SYMBOLS for b in range(256)], np.int8)
#: Some of the most frequent words of English, German, French and Spanish.
COMMON_WORDS = frozenset(
    b"the of and to in is that for it was on as with be by are this at from or an a der die das und ist von zu mit den ein eine im auf nicht es auch "
    b"le la les de des et un une est dans que pour par sur en du au el los las y del que se con para una su".split()
)
#: Counts of a text, in the order of the columns that counts() returns.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_bare", "n_marked", "n_shouts", "n_common")


def repeated_words(h: np.ndarray, words: int) -> int:
    """Words in windows of `words` words that are found twice or more, the first included; h: hashes of a text's words."""
    m = len(h) - words + 1
    if m < 2:
        return 0
    with np.errstate(over="ignore"):
        key = np.zeros(m, np.uint64)
        for k in range(words):
            key = key * (PRIME | np.uint64(1)) + h[k : k + m]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(m, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(m + words, np.int64)
    edge[:m] += again
    edge[words:] -= again
    return int((np.cumsum(edge) > 0).sum())


def counts(texts: list[bytes], words: int = 5) -> np.ndarray:
    """A row of COUNTS for each text."""
    buf = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    starts, ends = word_spans(buf, IS_WORD)
    h = word_hashes(buf, starts, ends)
    at = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    up_to = lambda kind: np.concatenate(([0], np.cumsum(kind[buf], dtype=np.int64)))
    letters, upper, odd = (x[ends] - x[starts] for x in map(up_to, (LETTER, UPPER, ODD)))
    of_words = [letters, upper, letters == 0, (odd > 0) & (letters > 0), buf[ends - 1] == 0x21 if len(ends) else np.zeros(0, bool)]
    sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[at]) for x in of_words]
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    out[:, 0] = np.diff(at)
    out[:, 6:11] = np.stack(sums, 1) if len(texts) else 0
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip()]
        out[i, 1:6] = len(t.translate(None, NOT_COUNTED)), len(t) - len(t.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(h[at[i] : at[i + 1]], words), len(lines)
        out[i, 11] = sum(map(COMMON_WORDS.__contains__, t.lower().split()))
    return out


@dataclass(frozen=True)
class Rule:
    """value: a number of each text from its counts (a column of each). Up to `good` the vote is good, from `bad` on it is
    bad, between them the rule abstains; it does so, too, on texts with fewer than `least` words."""

    name: str
    value: Callable[[dict[str, np.ndarray]], np.ndarray]
    good: float
    bad: float
    least: int = 10


def share(part: str, whole: str) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    return lambda c: c[part] / np.maximum(c[whole], 1)


#: The rules in production. A share of letters in capitals, say, is the usual one of sentences up to 0.15 and not from 0.4 on.
RULES = (
    Rule("symbols", share("n_symbols", "n_words"), 0.02, 0.1),
    Rule("marked words", share("n_marked", "n_words"), 0.01, 0.1),
    Rule("words without letters", share("n_bare", "n_words"), 0.05, 0.15),
    Rule("capitals", share("n_upper", "n_letters"), 0.15, 0.4),
    Rule("exclamations", share("n_shouts", "n_words"), 0.05, 0.2),
    Rule("word length", lambda c: np.abs(c["word_chars"] / np.maximum(c["n_words"], 1) - 6), 2.5, 5.5),
    Rule("repeated lines", share("n_dup_lines", "n_lines"), 0.1, 0.3),
    Rule("repeated words", share("n_repeat_words", "n_words"), 0.1, 0.2),
    Rule("common words", lambda c: 1 - c["n_common"] / np.maximum(c["n_words"], 1), 0.85, 0.98, 30),
)
ABSTAIN, BAD, GOOD = 0, 1, 2


def votes(found: np.ndarray, rules: Sequence[Rule]) -> np.ndarray:
    """A column for each rule: GOOD, BAD or ABSTAIN."""
    c = {name: found[:, k] for k, name in enumerate(COUNTS)}
    out = np.zeros((len(found), len(rules)), np.int64)
    for k, r in enumerate(rules):
        x = r.value(c)
        out[:, k] = np.where(c["n_words"] < r.least, ABSTAIN, np.where(x <= r.good, GOOD, np.where(x >= r.bad, BAD, ABSTAIN)))
    return out


@dataclass
class Accuracies:
    """prior: share of good texts. right: for bad and good texts how often each rule's vote, where it votes, is right."""

    prior: float
    right: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good; the prior if all rules abstain."""
        good, bad = np.log(self.right[1]), np.log(self.right[0])
        odds = np.log(self.prior / (1 - self.prior))
        odds = odds + (v == GOOD) @ (good - np.log1p(-self.right[0])) + (v == BAD) @ (np.log1p(-self.right[1]) - bad)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def estimate(patterns: np.ndarray, times: np.ndarray, *, rounds: int = 200, seen: float = 10.0) -> Accuracies:
    """Expectation-maximisation over the distinct vote patterns, each counted `times`; it starts from doubt at one bad vote.

    Rules vote independently given the quality, and abstaining says nothing. A share counts as if `seen` more texts had
    been right in 9 of 10, so no rule becomes certain; without texts all rules have that accuracy and the prior is 1/2.
    """
    w, good, bad = times.astype(float), patterns == GOOD, patterns == BAD
    p = np.where(~good.any(1), 0.5, np.choose(np.minimum(bad.sum(1), 2), [0.9, 0.5, 0.1]))
    out = None
    for _ in range(rounds):
        prior = (w @ p + 1) / (w.sum() + 2)
        right = np.stack([((w * q) @ side + 0.9 * seen) / ((w * q) @ (good | bad) + seen) for q, side in ((1 - p, bad), (p, good))])
        out = Accuracies(float(prior), right)
        new = out.posterior(patterns)
        if not len(p) or np.abs(new - p).max() < 1e-10:
            break
        p = new
    return out


def judge(
    docs: DataFrame, *, rules: Sequence[Rule] = RULES, least_words: int = 10, repeated: int = 20, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, good, kept.

    base_failed: fewer than `least_words` words, or over `repeated` per cent of them in windows of five words that stand
    twice or more. The other texts' votes are counted by pattern, of which there are 3 to the number of rules at most,
    whatever the number of texts; those counts go to the driver, which estimates the rules' accuracies. `good` is the
    posterior probability (also of texts that failed), kept is false for a text that failed and else whether it is `cut` or more.

    Null, empty and blank texts have no words and fail; texts of any length are counted whole, repeated rows each by
    itself; equal texts have equal results; other columns are ignored; an empty table gives an empty result.
    """
    if len(rules) > 12:
        raise ValueError("over 12 rules have more vote patterns than the driver should hold")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix = 3 ** np.arange(len(rules))
        for b in slices(batches, "text", 1 << 20):
            found = counts(text_bytes(b.column("text")))
            cols = [b.column("doc_id"), *(pa.array(found[:, k]) for k in range(5)), pa.array(votes(found, rules) @ radix)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *COUNTS[:5], "pattern"])

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS[:5])}, pattern long"
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeated * F.col("n_words"))
    found = materialize(found.withColumn("base_failed", failed), "votes")
    seen = found.groupBy("pattern").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("times")).orderBy("pattern").collect()  # 3^rules rows at most
    patterns = np.array([[r["pattern"] // 3**k % 3 for k in range(len(rules))] for r in seen], np.int64).reshape(-1, len(rules))
    fitted = estimate(patterns, np.array([r["times"] for r in seen], np.int64))
    good = [(r["pattern"], float(g)) for r, g in zip(seen, fitted.posterior(patterns), strict=True)]
    table = spark.createDataFrame(good, "pattern long, good double").coalesce(1)
    out = found.join(F.broadcast(table), "pattern")
    return out.select("doc_id", *COUNTS[:5], "base_failed", "good", (~F.col("base_failed") & (F.col("good") >= cut)).alias("kept"))
