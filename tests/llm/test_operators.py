"""The training-data operators against brute force, with nulls, empty tables, repeats, ties and clashing columns."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from formloom.llm import bottomk, common, decontam, lattice_lm, mixing, near_copies, quality, revisit, simhash, token_counts, token_pack, url_reputation
from formloom.llm.queries import RULES

WORDS = "the of and red blue green stone river tree house light dark over under again never always maybe Ünder naïve 日本 x1 don't".split()
SCHEMA = "doc_id long, text string, source string, fp long, h long, score double"


def texts(n=40, seed=1):
    r = random.Random(seed)
    out = [" ".join(r.choices(WORDS, k=r.randint(1, 60))) for _ in range(n)]
    out[3] = out[2]
    out[5] = out[4] + " again"
    return [*out, "", " \t\n", None, None, "word " * 3000, "<|endoftext|> a <|endof", "a" * 5000]


def table(spark, rows):
    return spark.createDataFrame([(i, t, f"s{i % 3}" if i % 5 else None, 1, 2, 0.5) for i, t in enumerate(rows)], SCHEMA).unionByName(
        spark.createDataFrame([(None, rows[0] if rows else None, None, 1, 2, 0.5)] * 2 if rows else [], SCHEMA)
    )


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, texts()).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_url_reputation(spark):
    urls = [None, "no scheme", "HTTP://A.Example.ORG/en/1?x", "https://example.org/es/a", "https://example.org", "http://x.com/fr/1#f", "http://ycom/fr/", "http://bad.net/a", "http://bad.net/b", "http://good.net/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(100 + i, "http://bad.net/c", "x") for i in range(40)] + [(200 + i, "http://good.net/d", "x") for i in range(20)], "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(9, 0), (9, 0)] + [(200 + i, 0) for i in range(20)], "id long, bad int")
    got = {r["page_id"]: r for r in url_reputation.host_reputation(pages, outcomes, RULES).collect()}
    assert len(got) == 70 and (got[0]["host"], got[0]["path"]) == ("", "") and got[1]["host"] == ""
    assert (got[2]["host"], got[2]["path"], got[2]["rule"], got[2]["verdict"]) == ("a.example.org", "/en/1", "example.org/en/1", "block")
    assert got[3]["rule"] == "example.org/es/" and got[4]["rule"] is None and got[5]["rule"] == "com/fr/" and got[6]["rule"] is None
    assert got[7]["verdict"] == "block" and got[9]["verdict"] == "allow"
    assert url_reputation.host_reputation(pages.limit(0), outcomes.limit(0)).count() == 0


def test_token_counts(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    tables = token_counts.prefix_tables(docs, path)
    got = token_counts.budget_counts(tables, budget=20).join(tables.drop("n_bytes"), "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(got) == len(texts())
    for r in got:
        t = r["text"] or ""
        assert r["n_tokens"] == len(own.encode(t, add_special_tokens=False).ids) and r["n_bytes"] == len(t.encode())
        for k in random.Random(2).sample(range(len(t) + 1), min(8, len(t))):
            n = len(own.encode(t[:k], add_special_tokens=False).ids)
            assert token_counts.tokens_of_prefix(r["prefix_steps"], len(t), k) == n and (n > 20 or k <= r["n_fit"])
        assert r["n_fit"] == token_counts.longest_prefix(r["prefix_steps"], len(t), 20)
    assert token_counts.budget_counts(token_counts.prefix_tables(none, path)).count() == 0
    far = np.array([1, 300, 2, 3])
    assert list(token_counts.unpacked(token_counts.packed(far), 4)) == list(far)


def test_quality(spark, none):
    r = random.Random(3)
    good = [" ".join(r.choices(WORDS, k=40)) for _ in range(120)]
    bad = [" ".join(w.upper() + "!!" for w in r.choices(WORDS, k=40)) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240)] + [(0, None), (None, 1)], "doc_id long, quality int")
    s = quality.Settings(bits=12, sample=150)
    got = {x["doc_id"]: x["score"] for x in quality.score(docs, quality.fit(docs, labels, s)).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i < 120) for i in held]) > 0.9 and got[900] == got[901] and 0 <= got[900] <= 1
    held_none = quality.fit(docs, labels, quality.Settings(bits=12, sample=150, held=0))  # features read anew for each epoch
    whole = quality.fit(docs, labels, s)
    assert np.array_equal(held_none.weights, whole.weights) and held_none.bias == whole.bias
    empty = quality.fit(none, labels.limit(0), s)
    assert quality.score(docs, empty).filter("score <> 0.5").count() == 0 and quality.keep_good(docs, empty).count() == docs.count()


def test_quality_training_by_hand():
    """The same descent, written for one text and one number at a time."""
    s = quality.Settings(bits=6, dim=3, epochs=3, batch=4)
    r = random.Random(5)
    some = [(r.choice(WORDS) + " ").encode() * r.randint(1, 5) + r.choice(WORDS).encode() for _ in range(13)] + [b""]
    labels = np.array([len(t) % 2 for t in some])
    found = quality.feature_counts(some, s)
    lengths = np.array([c.sum() for _, c in found])
    model = quality.train(lambda order: (found[k] for k in order.tolist()), lengths, labels, s)
    rng = np.random.default_rng(s.seed)
    size = 1 << s.bits
    v = rng.uniform(-1 / s.dim, 1 / s.dim, (size, s.dim)).astype(np.float32).astype(float)
    out = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32).astype(float)
    bias = np.log([np.mean(labels == 0), np.mean(labels == 1)])
    seen, seen_out = np.full(size, 1e-6), np.full((s.dim, 2), 1e-6)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        order = [i for i in rng.permutation(len(some)) if lengths[i]]
        for at in range(0, len(order), s.batch):
            grad, step, errors = np.zeros((s.dim, 2)), {}, []
            for i in order[at : at + s.batch]:
                share = {int(f): n / lengths[i] for f, n in zip(*found[i], strict=True)}
                hidden = sum(w * v[f] for f, w in share.items())
                z = np.exp(hidden @ out + bias)
                error = z / z.sum() - np.eye(2)[labels[i]]
                errors.append(error)
                grad += np.outer(hidden, error)
                for f, w in share.items():
                    step[f] = step.get(f, 0) + w * error @ out.T
            seen_out += grad**2
            out = out - rate * grad / np.sqrt(seen_out)
            bias = bias - 0.05 * rate * np.mean(errors, axis=0)
            for f, g in step.items():
                seen[f] += (g**2).mean()
                v[f] -= 0.5 * rate * g / np.sqrt(seen[f])
    assert np.allclose(model.weights, v @ (out[:, 1] - out[:, 0]), atol=2e-3) and abs(model.bias - (bias[1] - bias[0])) < 1e-4


def test_quality_scores_by_hand():
    s = quality.Settings(bits=10)
    m64, m32 = (1 << 64) - 1, (1 << 32) - 1

    def word(w):
        h = sum((b + 1) * pow(int(common.PRIME), i + 1, 1 << 64) for i, b in enumerate(w)) & m64
        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & m64
        return ((h ^ h >> 32) * 0xD6E8FEB86659FD93 & m64) >> (64 - s.bits)

    def gram(g):
        h = len(g)
        for b in g:
            h = (h * 0x01000193 + b + 1) & m32
        return (h * 0x9E3779B1 & m32) >> (32 - s.bits)

    def by_hand(text):
        words = text.split()
        ids = [word(w) for w in words] + [k for k in (1, 2) for a, b in zip(words, words[k:], strict=False) if a == b]
        padded = [b" " + w + b" " for w in words]
        return sorted(ids + [gram(w[i : i + n]) for n in s.grams for w in padded for i in range(len(w) - n + 1)])

    # the first word of a text is often the last one of the text before, which is no repetition
    some = [(t or "").encode() for t in texts()] + [b"tree", b"tree the tree", b"tree tree", b"", b"tree", b"a\tb\x0bb\r\nb"]
    found = quality.feature_counts(some, s)
    assert [np.repeat(ids, n).tolist() for ids, n in found] == [by_hand(t) for t in some]
    model = quality.Model(s, np.random.default_rng(1).normal(size=1 << s.bits).astype(np.float32), 0.3)
    mean = [np.mean(model.weights[by_hand(t)], dtype=np.float64) if t.split() else 0.0 for t in some]
    assert np.allclose(model.scores(some), 1 / (1 + np.exp(-np.array(mean) - 0.3)), atol=1e-6)
    assert np.allclose(model.scores(some), [model.scores([t])[0] for t in some], atol=1e-9)


def test_simhash(spark, docs, none):
    def brute(t):
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0

    rows = docs.collect()
    got = simhash.near_duplicates(docs).collect()
    fp = {r["doc_id"]: brute(r["text"]) for r in rows if r["doc_id"] is not None}
    assert len(got) == len(rows) and all(int(r["fingerprint"], 16) == fp[r["doc_id"]] for r in got if r["doc_id"] is not None)
    root = {i: i for i in fp}
    for _ in fp:
        for i in fp:
            root[i] = min(root[j] for j in fp if bin(fp[i] ^ fp[j]).count("1") <= 3)
    assert all(r["component_id"] == root[r["doc_id"]] for r in got if r["doc_id"] is not None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))
    clashing = docs.select("*", F.col("text").alias("_text"), F.lit(1).alias("row"), F.lit(2).alias("kept_id"))
    assert simhash.keep_one(clashing).columns == clashing.columns
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_chains(spark):
    r = random.Random(5)
    values = [r.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        x = r.choice(values)
        for b in r.sample(range(64), r.randint(1, 4)):
            x ^= 1 << b
        values.append(x)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    got = {x["node"]: x["root"] for x in simhash.components(edges).collect()}
    label = {v: v for v in signed}
    for _ in range(30):
        for v, s in zip(values, signed, strict=True):
            label[s] = min(label[t] for w, t in zip(values, signed, strict=True) if bin(v ^ w).count("1") <= 3)
    assert {s: got.get(s, s) for s in signed} == label


def test_pivots_discard():
    """In one bucket the pivots discard most pairs and lose none; both ways of searching a bucket find the same sets."""
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    near = values[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    values = np.unique(np.concatenate((values, near, near ^ np.uint64(5))))
    table = simhash.pivot_table(values, simhash.reference_fingerprints(24))
    i, j, met, left = simhash.pairs_within(values, np.zeros(len(values), int), table, 3)
    brute = {(a, b) for b in range(len(values)) for a in range(b) if bin(int(values[a]) ^ int(values[b])).count("1") <= 3}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == brute and len(brute) > 200
    assert met == len(values) * (len(values) - 1) // 2 and len(brute) <= left < met // 100
    roots, joined = simhash.linked_roots(values, table, 3), list(range(len(values)))
    for _ in range(10):
        for a, b in brute:
            joined[a] = joined[b] = min(joined[a], joined[b])
    assert roots.tolist() == joined
    assert all(len(simhash.bucket_masks(n, 3)) == k for n, k in ((0, 4), (1 << 20, 4), (1 << 30, 10), (1 << 36, 20)))


def test_near_copies(spark, docs, none):
    """One text of each group stays, by brute force over five-word shingles."""
    import corpus_pipeline

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def alike(a, b):
        return a == b or bool(a | b) and len(a & b) / len(a | b) >= 0.8

    r = random.Random(11)
    long = [r.choices([f"w{i}" for i in range(500)], k=r.randint(40, 300)) for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(long)]
    for k in range(120):  # copies with some words changed, near the threshold on either side, and copies of copies
        w = r.choice(rows)[1].split()
        for at in r.sample(range(len(w)), r.randint(1, max(1, len(w) // 40))):
            w[at] = "edited"
        rows.append((100 + k, " ".join(w)))
    rows += [(300, rows[0][1].upper()), (None, rows[1][1]), (301, "a b"), (302, "A  b"), (303, "a c"), (304, ""), (305, None), (300, rows[0][1].upper())]
    given = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, h int")
    got = corpus_pipeline.near_dedup(spark, given, "")
    assert got.columns == given.columns
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for _ in range(10):
        for i, a in enumerate(sets):
            group[i] = min(group[j] for j, b in enumerate(sets) if alike(a, b))
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, 1 << 60), 1 << 60 if i is None else i)
    assert 10 < len(least) < 100 and sorted(x["doc_id"] for x in got.collect()) == sorted(least.values())
    parted = simhash.keep_one(given, words=5, alike=0.8, limit=3).collect()  # the same in pieces of three texts
    assert sorted(x["doc_id"] for x in parted) == sorted(least.values())
    kept = simhash.keep_one(docs, words=5, alike=0.8)
    assert kept.columns == docs.columns and simhash.keep_one(none, words=5, alike=0.8).count() == 0


def test_chains_of_near_copies(spark):
    """Six chains of four texts, neighbours alike by 0.8 and ends not, and 40 pages of one template, none alike: no link is
    lost whatever the size of a bucket's pieces, and long texts and pairs just below the threshold stay."""
    words = lambda chain, k: [f"c{chain}x{(i if i >= 40 * k else i + 1000)}" for i in range(420)]
    rows = [(10 * c + k, " ".join(words(c, k))) for c in range(6) for k in range(4)]
    first = [set(zip(*(words(0, k)[i:] for i in range(5)), strict=False)) for k in range(4)]
    alike = lambda a, b: len(a & b) / len(a | b)
    assert all(alike(first[k], first[k + 1]) >= 0.8 for k in range(3)) and alike(first[0], first[2]) < 0.8
    rows += [(1000 + p, " ".join([f"t{i}" for i in range(70)] + [f"p{p}w{i}" for i in range(15)])) for p in range(40)]
    rows += [(2000, "v " * 100_000 + "x"), (2001, "v " * 100_000 + "y z")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), words=5, alike=0.8, limit=2)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted([0, 10, 20, 30, 40, 50, *range(1000, 1040), 2000, 2001])


def test_tiles(monkeypatch):
    """Pairs are left to the first bucket that they share, and verified there in whatever tiles."""
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in rng.integers(20, 400, 30)]
    sets = [np.unique(np.concatenate((b[rng.random(len(b)) > 0.06], rng.integers(0, 1 << 62, 3).astype(np.uint64)))) for b in base for _ in range(9)]
    sets.sort(key=len)
    sig, n = near_copies.band_keys(sets, 32, 5), np.array([len(s) for s in sets])
    fp = np.array([near_copies.majority(s) for s in sets], np.uint64)
    brute = {(i, j) for j in range(len(sets)) for i in range(j) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    for most in (256, 7):
        monkeypatch.setattr(near_copies.chunks, "__defaults__", (most, 400_000))
        root = list(range(len(sets)))
        for band in range(32):
            _, bucket = np.unique(sig[:, band], return_inverse=True)
            for b in range(bucket.max() + 1):
                rows = np.flatnonzero(bucket == b)
                for _, _, some in near_copies.tiles(band, n[rows], fp[rows], sig[rows], 0.8):
                    for i, j in near_copies.alike_pairs([sets[k] for k in rows[some]], 0.8):
                        i, j = int(rows[some[i]]), int(rows[some[j]])
                        assert (min(i, j), max(i, j)) in brute
                        root = [root[i] if x == root[j] else x for x in root]
        assert len(brute) > 100 and all(root[i] == root[j] for i, j in brute)


def test_mixing(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in got)
    assert abs(sum(v[0]["target"] for v in by.values()) - 1.5 * total) < 1e-6 * total
    weight = dict(zip([*sorted(s for s in by if s), None], (3, 1, 2, 3), strict=False))
    cap, target, left = {s: 2 * v[0]["source_size"] for s, v in by.items()}, {}, 1.5 * total
    free = set(by)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap[s]}
        for s in over or free:
            target[s] = cap[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    for s, v in by.items():
        assert abs(v[0]["target"] - target[s]) < 1e-6 * total
        assert abs(sum(r["taken"] for r in v) - target[s]) <= max(r["size"] for r in v)
    assert mixing.mix(none).count() == 0
    assert mixing.repeat(docs, mixing.mix(docs)).columns == docs.columns


def test_token_pack(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    where, manifest = token_pack.write_packed(docs, path, end=2, vocabulary=49408)
    got = sorted(token_pack.read_packed(where, manifest).collect(), key=lambda r: r["start"])
    text, start = dict((r["doc_id"], r["text"]) for r in docs.collect()), 0
    assert [r["doc_id"] for r in got][2:] == sorted(i for i in text if i is not None)
    for r in got:
        ids = [*own.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_pack.read_packed(*token_pack.write_packed(none, path, end=2, vocabulary=49408)).count() == 0


def test_shard_random_access():
    rng = np.random.default_rng(1)
    for bits in (1, 5, 8, 13, 16, 17, 24, 31):
        docs = [(i if i % 7 else None, rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4").tobytes()) for i, n in enumerate((0, 1, 300, 7, 129))]
        shard = token_pack.Shard(token_pack.shard_bytes(docs, bits, block=64))
        assert all((shard.document(i) == np.frombuffer(x, "<u4")).all() for i, (_, x) in enumerate(docs))
        flat = np.frombuffer(b"".join(x for _, x in docs), "<u4")
        assert (shard.ids(100, 250) == flat[100:250]).all()


def test_decontamination(spark, none):
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=6))
    items = [" ".join(word() for _ in range(n)) + "." for n in (20, 35, 50, 70, 6)]
    clean = [" ".join(word() for _ in range(r.randint(1, 200))) for _ in range(60)]
    leak = [clean[i] + " " + items[i % 5].upper() + " " + clean[-i - 1] for i in range(15)]
    changed = items[2].split()
    changed[5:8] = [word() for _ in range(3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*clean, *leak, " ".join(changed), None, ""])], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(9, None), (10, "")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontam.contamination(docs, bench).collect()}
    assert got == {(60 + i, i % 5) for i in range(15)} | {(75, 2)}
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 16
    assert decontam.contamination(docs, bench.limit(0)).count() == 0 and decontam.contamination(none.select("doc_id", "text"), bench).count() == 0


def test_decontamination_of_common_items(spark):
    """An item is found though all its words are in over a fifth of the documents, or there are few documents at all."""
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=6))
    items = [" ".join(word() for _ in range(n)) + "." for n in (24, 40, 5)]
    clean = [" ".join(word() for _ in range(r.randint(1, 120))) for _ in range(60)]
    hot = " ".join([clean[0], items[0], clean[1], items[2], clean[2]])
    for rows in ([*clean, *[hot] * 30, items[0] + " " + clean[5], items[1]], [items[0], items[2], clean[3]], [items[2]]):
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        for some in (items, items[:1], items[2:]):
            bench = spark.createDataFrame(list(enumerate(some)), "item_id long, text string")
            got = sorted((x["doc_id"], x["item_id"]) for x in decontam.contamination(docs, bench).collect())
            assert got == [(d, i) for d, t in enumerate(rows) for i, x in enumerate(some) if x.rstrip(".") in t]
            assert decontam.decontaminate(docs, bench).count() == len(rows) - len({d for d, _ in got})


def test_decontamination_recall(spark):
    """Paraphrases without an item's rarest words, and short items, against brute force over the regions of all windows."""
    r, s = random.Random(13), decontam.Settings()
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=6)) for _ in range(800)]
    draw = lambda n: r.choices(vocabulary, [1 / (i + 1) for i in range(800)], k=n)
    items = [draw(n) for n in [*range(12, 60, 2), 3, 5, 7]]
    rank = {w: i for i, w in enumerate(vocabulary)}
    rows = []
    for k, w in enumerate(items * 2):
        n, w = len(w), list(w)
        places = sorted(range(n), key=lambda i: -rank[w[i]])[: 0 if n < s.short else n // 5]
        for i in places:
            w[i] = f"new{i}"
        rows.append(" ".join([*draw(r.randint(0, 90)), *w, *draw(r.randint(0, 90))]))
    rows += [" ".join(draw(r.randint(1, 200))) for _ in range(60)]
    want = set()
    for d, t in enumerate(rows):
        words = t.encode().split()
        for i, w in enumerate(items):
            item = [x.encode() for x in w]
            regions = (words[max(0, lo - len(item)) : lo + s.window + len(item)] for lo, _ in decontam.windows(len(words), s))
            if any(decontam.verify(item, item, x, s)[0] for x in regions):
                want.add((d, i))
    assert len(want) >= 2 * len(items)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontam.contamination(docs, bench).collect()}
    print(f"recall {len(got & want)} of {len(want)}")
    assert got == want


def test_decontamination_recall_by_change(spark):
    """Shares of an item's words replaced, its rarest first or at random, or moved, against brute force over all regions."""
    r, s = random.Random(17), decontam.Settings()
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=6)) for _ in range(600)]
    draw = lambda n: r.choices(vocabulary, [1 / (i + 1) for i in range(600)], k=n)
    items = [(draw(n), draw(5)) for n in range(12, 52, 4)]
    rank = {w: i for i, w in enumerate(vocabulary)}
    rows, cells = [], []
    for share in (0.1, 0.2, 0.3):
        for how in ("rarest", "random", "moved"):
            for i, (body, answer) in enumerate(items):
                w, n = list(body), round(share * len(body))
                places = sorted(range(len(w)), key=lambda k: -rank[w[k]])[:n] if how == "rarest" else sorted(r.sample(range(len(w)), n))
                if how == "moved":
                    taken = [w[k] for k in places]
                    w = [x for k, x in enumerate(w) if k not in places]
                    for x in taken:
                        w.insert(r.randint(0, len(w)), x)
                else:
                    for k in places:
                        w[k] = f"new{k}"
                rows.append(" ".join([*draw(r.randint(0, 90)), *w, *answer, *draw(r.randint(0, 90))]))
                cells.append((how, share, i))
    rows += [" ".join(draw(r.randint(1, 200))) for _ in range(20)]
    folded = [([x.encode() for x in b + a], [x.encode() for x in a]) for b, a in items]
    want = set()
    for d, t in enumerate(rows):
        words = t.encode().split()
        for i, (item, answer) in enumerate(folded):
            regions = (words[max(0, lo - len(item)) : lo + s.window + len(item)] for lo, _ in decontam.windows(len(words), s))
            if any(decontam.verify(item, answer, x, s)[0] for x in regions):
                want.add((d, i))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(b + a), " ".join(a)) for i, (b, a) in enumerate(items)], "item_id long, text string, answer string")
    got = {(x["doc_id"], x["item_id"]) for x in decontam.contamination(docs, bench, answer_col="answer").collect()}
    for cell in sorted({c[:2] for c in cells}):
        planted = {(d, c[2]) for d, c in enumerate(cells) if c[:2] == cell}
        leaks = planted & want
        print(*cell, f"planted {len(planted)}, leaks by brute force {len(leaks)}, found {len(leaks & got)}")
        assert len(leaks & got) >= 0.9 * len(leaks)
    print(f"all pairs: {len(got & want)} of {len(want)}")
    assert got <= want and len(got & want) >= 0.9 * len(want) and len(want) >= len(cells) / 2


def test_revisits(spark):
    m = lambda **h: {k.replace("_", "-"): v for k, v in h.items()}
    rows = [
        (1, "http://A.com:80/x#f", 10, "response", m(ETag='"1"', Content_Type="t", Date="d1")), (2, "https://a.com/x", 20, "response", m(ETag='"2"', Date="d2")), (3, "http://a.com/x", 20, "revisit", m(ETag='W/"1"', Date="d3", X_Other="o")),
        (4, "http://a.com/x", 21, "revisit", m(ETag='"1"')), (5, "http://a.com/x", 99999, "revisit", None), (6, None, 5, "revisit", None), (7, "http://b.com/?b=2&a=1", 7, "response", m(Last_Modified="l")),
        (8, "http://b.com/?a=1&b=2", 5000, "revisit", m(Last_Modified="l")), (9, "http://a.com/x", 10, "revisit", None), (10, "http://a.com/x", 3, "request", None),
    ]
    records = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>")
    got = {r["record_id"]: r for r in revisit.resolve_revisits(records).collect()}
    assert {k: (r["response_id"], r["status"]) for k, r in got.items()} == {3: (1, "resolved"), 4: (2, "mismatch"), 5: (2, "unverified"), 6: (None, "missing"), 8: (7, "resolved"), 9: (None, "missing")}
    assert got[3]["headers"] == {"etag": 'W/"1"', "content-type": "t", "date": "d3"}
    assert revisit.resolve_revisits(records.limit(0)).count() == 0


def test_lattice(spark, docs, none):
    import math
    from collections import Counter

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = lattice_lm.Lattice(path)
    index = {p: i for i, p in enumerate(own.pieces)}

    def brute(word):
        x = b" " + word
        a = [1.0] + [0.0] * len(x)
        for i in range(1, len(x) + 1):
            a[i] = sum(a[j] * math.exp(own.initial[index[x[j:i]]]) for j in range(max(0, i - own.longest), i) if x[j:i] in index)
        return math.log(a[-1])

    words = [w.lower().encode() for w in WORDS] + [b"q" * 30, "日本語".encode()]
    assert np.allclose(own.log_likelihood(words, own.initial), [brute(w) for w in words])
    long = np.frombuffer(b" " + words[0], np.uint8)
    assert math.isclose(own._one(long, np.append(own.initial, -np.inf)), brute(words[0]))
    got = {r["doc_id"]: r for r in lattice_lm.score_texts(docs, path, hot=5).collect()}
    rows = [r for r in docs.collect()]
    c, ends = Counter(), 0
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 5 != 1:
            c.update((r["text"] or "").encode().lower().split())
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    for r in rows:
        if r["doc_id"] is None:
            continue
        t, g = (r["text"] or "").encode().lower().split(), got[r["doc_id"]]
        base = sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in [*(c[w] for w in t), ends])
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(t) + 1, 1 + sum(c[w] > 0 for w in t), n)
        assert math.isclose(g["base_score"], base, rel_tol=1e-9) and -1e6 < g["score"] < 0
    assert lattice_lm.score_texts(none, path).count() == 0


def test_bottomk(spark, docs, none):
    import hashlib

    def sketch(t):
        w = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        s = {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        return sorted((h - (1 << 64) if (h := xxhash.xxh64_intdigest(x, 42)) >> 63 else h) for x in s)[:128]

    def near(a, b):
        both = sorted({*a, *b})[:128]
        return len([x for x in both if x in a and x in b]) / len(both) if both else 1.0

    rows = [r for r in docs.filter("doc_id is not null").collect()]
    t = {r["doc_id"]: r["text"] or "" for r in rows}
    got = {r["doc_id"]: r for r in bottomk.edited_pairs(docs.filter("doc_id is not null")).collect()}
    order = sorted(t, reverse=True)
    assert len(got) == len(t)
    for i, nxt in zip(order, [*order[1:], order[0]], strict=True):
        k = len(t[i]) // 3
        edited = t[i][: len(t[i]) - k] + t[nxt][:k]
        a, b, g = sketch(t[i]), sketch(edited), got[i]
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and g["n_chars"] == len(t[i])
        assert g["fingerprint"] == "".join(f"{x % (1 << 64):016x}" for x in a) and g["edited_fingerprint"] == "".join(f"{x % (1 << 64):016x}" for x in b)
        assert abs(g["near_edited"] - near(a, b)) < 1e-12 and abs(g["near_next"] - near(a, sketch(t[nxt]))) < 1e-12
    assert bottomk.edited_pairs(docs).count() == docs.count() and bottomk.edited_pairs(none).count() == 0
    parts = docs.select(F.lit(1).alias("g"), bottomk.sketch(F.coalesce("text", F.lit(""))).alias("s"))
    whole = sorted({x for v in t.values() for x in sketch(v)})[:128]
    assert bottomk.merge_all(parts, ["g"], "s").first()["s"] == whole


def test_bottomk_estimates(spark):
    r = random.Random(9)
    own, other = ([str(r.random()) for _ in range(n)] for n in (900, 600))
    shared = own[:300] + other
    rows = [(" ".join(own), " ".join(shared), " ".join(own[:60])), ("", "", ""), (None, "a b", "a b")]
    t = spark.createDataFrame(rows, "x string, y string, z string")
    t = t.select(*(bottomk.sketch(F.col(c)).alias(c) for c in "xyz"))
    x, y, z = (F.col(c) for c in "xyz")
    got = t.select(
        bottomk.distinct_count(x).alias("n"), bottomk.distinct_count(z).alias("few"), bottomk.containment(z, x).alias("inside"), bottomk.containment(x, y).alias("part"),
        bottomk.resemblance(x, y).alias("alike"), bottomk.distinct_count(bottomk.merge(x, y)).alias("both"), (bottomk.merge(x, y) == bottomk.merge(y, x)).alias("either"),
    ).collect()
    a, b, c = got
    # 896 and 896 shingles, of which both have 296; 128 hashes estimate within about a tenth
    assert abs(a["n"] / 896 - 1) < 0.3 and a["few"] == 56 and a["inside"] > 0.7 and abs(a["part"] - 0.33) < 0.12 and abs(a["alike"] - 0.198) < 0.1 and abs(a["both"] / 1496 - 1) < 0.3
    assert all(g["either"] for g in got)
    assert (b["n"], b["few"], b["inside"], b["part"], b["alike"], b["both"]) == (0, 0, 1, 1, 1, 0)
    assert (c["n"], c["few"], c["inside"], c["part"], c["alike"], c["both"]) == (0, 1, 0, 1, 0, 1)


def test_encoder_is_the_library():
    """Distinct words go through another path than the library's; the ids are the same, in any script, and for null, blank and special texts."""
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, library, rnd = token_pack.Encoder(path, memo=50), Tokenizer.from_file(path), random.Random(5)
    letters = "aAbz'sStTdD  \n\t09!?.éÉñÑü×÷ÿ日İ́ \x85\x1c-"
    texts = [None, "", " ", "\n\n a\n", "<|endoftext|> hi", "WE'LL 12'd", "x" * 3000, " lead", "tail  "]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(2000)]
    for some in (texts, texts[:1], []):
        got = own.encode(pa.array(some, pa.string()), 2)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in some]
