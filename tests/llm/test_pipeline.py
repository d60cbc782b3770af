"""The pipeline's stages, each against brute force over its own input, with nulls, repeats, clashing columns and empty tables."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from formloom.llm import mixing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, times int, row string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def rows_of(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(21)
    good = ["".join(r.choices("abcdefgh", k=5)) for _ in range(300)]
    bad = [w.upper() + "!!$" for w in good]
    item = " ".join(r.choices(good, k=30)) + "."
    texts = [" ".join(r.choices(good if i % 3 else bad, k=r.randint(30, 120))) for i in range(120)]
    texts[50] = " ".join(texts[49].split()[:-1] + ["edited"])  # a near copy
    texts[52] = texts[49]
    texts[61] = texts[61] + " " + item + " " + texts[62]  # a leak
    texts += [None, "", " \n ", "word", "<|endoftext|> x"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "x", 3, "r") for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, texts[11], "en", None, 1, "y", 1, "q"), (None, None, None, None, None, None, None, None)]
    where = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def test_stages_and_run(spark, folder, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        out[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "token_files" or docs.columns == COLUMNS
    start = spark.read.parquet(f"{folder}/documents.parquet")
    # quality: exactly the rows that the classifier scores 0.3 or more
    model = quality.fit(start, spark.read.parquet(f"{folder}/labels.parquet"), folds=5, held_out=0)
    given = start.collect()
    scores = model.scores([(r["text"] or "").encode() for r in given])
    assert rows_of(out["quality"]) == Counter(tuple(r[c] for c in COLUMNS) for r, s in zip(given, scores, strict=True) if s >= 0.3)
    assert {r["doc_id"] % 3 for r in out["quality"].collect() if r["doc_id"] is not None and r["doc_id"] < 120} == {1, 2}
    # near copies: one row of each group of linked texts, that with the least id

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    before = [(r["doc_id"], shingles(r["text"])) for r in out["quality"].collect()]
    alike = lambda a, b: a == b or bool(a | b) and len(a & b) / len(a | b) >= 0.8
    group = list(range(len(before)))
    for _ in range(5):
        group = [min(group[j] for j, (_, b) in enumerate(before) if alike(a, b)) for _, a in before]
    least = {}
    for (i, _), g in zip(before, group, strict=True):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    kept = [r["doc_id"] for r in out["near_dedup"].collect()]
    assert sorted(kept, key=str) == sorted((None if n else i for n, i in least.values()), key=str) and len(kept) < len(before) and 50 not in kept and 52 not in kept
    # decontamination: the planted leak goes, all else stays
    clean = [r["doc_id"] for r in out["decontamination"].collect()]
    assert sorted(set(kept) - set(clean), key=str) == [61] and len(clean) == len(kept) - 1
    # mixing: each row as often as its place in the mix says, twice at most, sources near their targets
    mixed = mixing.mix(out["decontamination"], weights=(3, 1, 2), budget=1.5, max_epochs=2).collect()
    times = {r["doc_id"]: r["repetitions"] for r in mixed}
    copies = Counter(r["doc_id"] for r in out["mixing"].collect())
    assert copies == Counter({i: n for i, n in times.items() if n}) and max(times.values()) <= 2
    for s in {r["source"] for r in mixed}:
        own = [r for r in mixed if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    # token files: the library's ids, in order of ids
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text, at = {r["doc_id"]: r["text"] for r in out["mixing"].collect()}, 0
    for r in sorted(out["token_files"].collect(), key=lambda r: r["start"]):
        ids = [*library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str) == sorted(map(tuple, out["token_files"].collect()), key=str)


def test_stages_of_nothing(spark, folder, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_shards_roll(spark, folder):
    """Small shards, whatever the partitions: the same ids in more files."""
    from formloom.llm import token_pack

    docs = spark.read.parquet(f"{folder}/documents.parquet").filter(F.col("doc_id").isNotNull())
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = token_pack.read_packed(*token_pack.write_packed(docs, path, end=2, vocabulary=49408)).collect()
    where, manifest = token_pack.write_packed(docs, path, end=2, vocabulary=49408, shard_ids=500)
    assert manifest.count() > 10 and all(r["n_ids"] < 3000 for r in manifest.collect())
    assert sorted(map(tuple, token_pack.read_packed(where, manifest).collect())) == sorted(map(tuple, whole))


def test_header_names_and_item_ids(spark):
    from formloom.llm import decontam, revisit

    rows = [(1, "http://a.com/", 1, "response", {"ETag": '"1"', "etag": '"2"'}), (1, "http://a.com/", 1, "response", {"ETag": '"0"'}), (2, "http://a.com/", 5, "revisit", {"etag": '"1"', "ETAG": '"9"'})]
    records = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>")
    (got,) = revisit.resolve_revisits(records).collect()
    assert (got["response_id"], got["status"], got["headers"]) == (1, "mismatch", {"etag": '"9"'})
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")  # nothing but equal documents
    bench = spark.createDataFrame([("a", text), ("b", "quite another one " * 4)], "item_id string, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contamination(docs, bench).collect()} == {(i, "a") for i in range(30)}


def test_scores_are_sums_over_segmentations(spark):
    """op9: lattice_score and score by brute force over all segmentations, with the vocabulary's own scores; long words too."""
    import math

    from formloom.llm import lattice_lm

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = lattice_lm.Lattice(path)
    index = {p: i for i, p in enumerate(own.pieces)}

    def over_all(word):
        x, a = b" " + word, [1.0]
        for i in range(1, len(x) + 1):
            a.append(sum(a[j] * math.exp(own.initial[index[x[j:i]]]) for j in range(max(0, i - own.longest), i) if x[j:i] in index))
        return a[-1]

    texts = ["the red fox", "the Dog", None, "z" * 40 + "ab" * 20, "日本語 the", "the the new", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 != 1]
    words = lambda i: (texts[i] or "").encode().lower().split()
    c = Counter(w for i in train for w in words(i))
    total, ends = sum(c.values()), len(train)
    u, e = min(max(sum(n == 1 for n in c.values()) / total, 1e-4), 0.9), (ends + 0.5) / (total + ends + 1)
    for r in lattice_lm.score_texts(docs, path, hot=2).collect():
        want = math.log10(e) + sum(math.log10((1 - e) * ((1 - u) * c[w] / total + u * over_all(w))) for w in words(r["doc_id"]))
        assert math.isclose(r["score"], want, rel_tol=1e-9) and math.isclose(r["lattice_score"], sum(math.log10(over_all(w)) for w in words(r["doc_id"])), rel_tol=1e-9, abs_tol=1e-12)
