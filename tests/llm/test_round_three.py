"""Operators 11 to 13 against brute force, with nulls, empty tables, repeats, ties and clashing columns."""

import random
import zlib
from hashlib import sha256

import numpy as np
import numpy as np
import pytest
from pyspark.sql import functions as F

from formloom.llm import hard_negatives, merkle, mixing, revisit, url_reputation, weak_rules
from formloom.llm.queries import RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp string"


def rows(n=60, seed=5):
    r = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", None, "é", ""]
    out = [(i * 7 % 101, " ".join(r.choices(["The", "a", "ünd", "x1"], k=r.randint(0, 30))), r.choice(langs), r.choice(["s1", None]), r.choice([None, 5, 12]), "x", "y") for i in range(n)]
    out += [(None, None, "en", None, None, None, None)] * 2 + [(500, "T" * 70_000, "zz", "s", 70_000, "", "")] + [out[3], out[3]]
    return out


def brute_manifest(given, fanout):
    h = lambda x: sha256(x.encode()).hexdigest()
    frame = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    leaf = lambda r, t: h("".join(map(frame, (r[0], r[3], r[2], r[4], t))))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
        return out

    groups = {}
    for r in given:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            doc_id = "" if r[0] is None else str(r[0])
            node = leaf(r, lower(r[1])) if zlib.crc32(doc_id.encode()) % 3 == 0 else own
            proof = ""
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    a = at // fanout * fanout
                    left, right = "".join(level[a:at]), "".join(level[at + 1 : a + fanout])
                    proof += left + right
                    node = h(left + node + right)
                    at //= fanout
            out.append((r[0], own, trees[k][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize(("fanout", "levels"), [(8, 3), (3, 1)])
def test_manifest(spark, fanout, levels):
    given = rows()
    got = merkle.manifest(spark.createDataFrame(given, DOCS).repartition(5), fanout=fanout, levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: tuple(map(str, r))
    want = brute_manifest(given, fanout)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {r[6] for r in want} == {True, False}
    assert merkle.manifest(spark.createDataFrame([], DOCS), fanout=fanout, levels=levels).count() == 0
    one = merkle.manifest(spark.createDataFrame(given[:1], DOCS)).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha256(b"").hexdigest()


def brute_negatives(given, positives=5, negatives=10, low=30, high=90):
    best = {}
    for i, v, lab in given:
        if i is not None and v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v):
            best[i] = min(best.get(i, (lab, v)), (lab, v))
    least, most = hard_negatives.LEAST, hard_negatives.MOST
    rows = {i: (lab, [min(max(int(np.floor(256.0 * x)), least), most) for x in v]) for i, (lab, v) in best.items()}
    score = lambda a, b: min(max(sum(x * y for x, y in zip(rows[a][1], rows[b][1])), least), most)  # noqa: B905, E731  the shorter one has zeros
    out = []
    for a in rows:
        if a % 100 == 0:
            order = sorted(((-score(a, b), b) for b in rows if b != a))
            for s, p in [x for x in order if rows[x[1]][0] == rows[a][0]][:positives]:
                fit = [(-n, b) for n, b in order if rows[b][0] != rows[a][0] and low * -s <= 100 * -n <= high * -s][:negatives]
                out += [(a, p, k + 1, b, -s, n) for k, (n, b) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "ties", "large"])
def test_hard_negatives(spark, kind):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (700, 6)) * rng.lognormal(0, 1, (700, 1)) if kind != "ties" else rng.integers(-1, 2, (700, 6)) / 4
    given = [(i, [float(y) for y in v], int(i % 3)) for i, v in enumerate(x)]
    given[40:48] = [(40, None, 1), (41, [1.0, float("nan")], 1), (42, [float("inf")], 0), (43, [None, 1.0], 0), (None, [1.0], 0), (45, [1.0], None), (46, [], 0), (47, [1.0, 2.0], 2)]
    given += [given[5], (5, [9.0] * 6, 2), (-100, [1.0] * 6, 1), (800, [0.0] * 6, 1)]
    if kind == "large":
        given += [(801 + i, [1e17, -3e16 * i, 1e300, 1.0], i % 3) for i in range(6)] + [(900, [1e17] * 3, 0)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit(1), "score": F.lit(2), "v": F.lit(None).cast("string")})
    got = hard_negatives.mine(df.repartition(3), F.col("id") % 100 == 0, size=64, anchors_size=3, at_once=1 if kind == "ties" else 64)
    want = brute_negatives(given)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hard_negatives.mine(df.limit(0), F.col("id") % 100 == 0).count() == 0 and hard_negatives.mine(df.filter("vec_id = 1"), F.col("id") % 100 == 0).count() == 0


def test_norm_bounds_prune(spark):
    """A block whose norms can't reach the limit isn't joined, and an anchor whose running k-th score is higher isn't scored."""
    rows = [(i, [100.0 if i < 64 else 0.1, 0.0], i % 2) for i in range(640)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label long").select("id", "label", F.transform("v", lambda y: (y * 256).cast("long")).alias("v"), (F.get("v", 0) * 256).alias("norm"))
    blocks = hard_negatives.blocks(df, [], 64).cache()
    limit = lambda x: F.array(F.lit(x).cast("long"))
    anchors = hard_negatives.blocks(df.filter("id = 0").select("id", "label", "v", "norm", limit(10**8).alias("low"), limit(10**9).alias("high")), ["low", "high"], 8)
    found = hard_negatives.nearest(blocks, anchors, 5, 1, False, [], 1)
    plan = found._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" in plan and "least" in plan and 5 <= found.count() <= 10
    assert {r["other"] for r in found.collect()} >= {1, 3, 5, 7, 9} and found.agg(F.max("other")).first()[0] < 64
    assert 0 < blocks.join(anchors.select(F.col("least"), F.col("norm").alias("a")).withColumnRenamed("least", "l"), F.col("norm") * F.col("a") + 1 >= F.col("l")).count() < blocks.count()
    best = hard_negatives.Best(2, np.array([[0]]), np.array([[100]]))
    best.add(np.array([0, 0, 0]), np.array([5, 9, 9]), np.array([1, 8, 3]))
    assert best.id.tolist() == [3, 8] and best.floor.tolist() == [9]


def brute_counts(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip("\t\x0b\x0c\r ")]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def weak_texts():
    r = random.Random(9)
    words = "the of and to in stone river tree ünder naïve 日本 don't house\u00a0x".split(" ")
    plain = [" ".join(r.choices(words, k=r.randint(12, 80))) for _ in range(150)]
    junk = [" ".join(w + "###" for w in r.choices(words, k=40)) for _ in range(12)] + [" | ".join(r.choices(words, k=40)) for _ in range(12)]
    odd = [None, "", " \n\t ", "one two", "a\nb\na\n\nb\n \n", "w " * 5000, "x" * 90_000, "a b c d e f a b c d e", "p\x1cq \x0br", "a b c d e " * 2 + "\nline\nline", "日 " * 20]
    return plain + junk + odd + [plain[0]] * 3


def test_weak_rules(spark):
    texts = weak_texts()
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in enumerate(texts)] + [(None, texts[0], 1, 2.0)] * 2, "doc_id long, text string, pattern int, good double").repartition(3)
    got = weak_rules.judge(df).collect()
    assert len(got) == len(texts) + 2
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, t in enumerate(texts):
        r, want = by[i], brute_counts(t or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r["kept"] == (not r["base_failed"] and r["good"] >= 0.5)
    assert all(by[i]["kept"] for i in range(150) if not by[i]["base_failed"]) and not any(by[i]["kept"] for i in range(150, 174))
    assert sum(by[i]["kept"] for i in range(150)) > 140
    assert weak_rules.judge(df.limit(0)).count() == 0


def test_expectation_maximisation():
    """Against the same model fitted text by text, without patterns; a rule that votes at random gets no weight."""
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.8
    right = (0.95, 0.9, 0.85, 0.5)
    v = np.stack([np.where(rng.random(4000) < 0.3, 0, np.where((rng.random(4000) < a) == y, 2, 1)) for a in right], 1)
    patterns, at, times = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    fitted = weak_rules.estimate(patterns, times)
    p = np.array([(0.9, 0.5, 0.1, 0.1, 0.1)[(x == 1).sum()] if (x == 2).any() else 0.5 for x in v])
    for _ in range(200):
        prior, odds = (p.sum() + 1) / (len(p) + 2), 0.0
        for k in range(4):
            of = lambda q, side, k=k: ((q * (v[:, k] == side)).sum() + 9) / ((q * (v[:, k] > 0)).sum() + 10)
            good, bad = of(p, 2), of(1 - p, 1)
            odds = odds + np.where(v[:, k] == 2, np.log(good / (1 - bad)), 0) + np.where(v[:, k] == 1, np.log((1 - good) / bad), 0)
        p = 1 / (1 + np.exp(-odds - np.log(prior / (1 - prior))))
    assert np.allclose(fitted.posterior(patterns)[at.ravel()], p, atol=1e-6)
    assert np.abs(fitted.right - np.array(right)).max() < 0.05 and abs(fitted.prior - 0.8) < 0.03
    assert ((p > 0.5) == y).mean() > ((v == 2).sum(1) > (v == 1).sum(1)).__eq__(y).mean()


def test_burst_of_one_url(spark):
    """Hundreds of records of one URL in a short time, with long URLs and headers, against brute force."""
    r = random.Random(8)
    url, pad = "http://a.org/x?" + "q" * 5000, "h" * 2000
    rows = [(i, url, 1000 + r.randint(0, 400), "response", {"ETag": f'"{i % 3}"', "X": pad}) for i in range(250)] + [(5000 + i, url, 1000 + r.randint(0, 400), "revisit", {"ETag": f'"{i % 3}"'}) for i in range(250)]
    rows += [(9000, "http://b.org/", 5, "response", {"ETag": '"b"'}), (9001, "http://b.org/", 10**9, "revisit", {"ETag": '"b"'})]  # far apart
    got = {x["record_id"]: x["response_id"] for x in revisit.resolve_revisits(spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>")).collect()}
    for i, u, ts, kind, _ in rows:
        if kind == "revisit":
            before = [(x[2], x[0]) for x in rows if x[3] == "response" and x[1] == u and x[2] < ts]
            latest = [k for t, k in before if t == max(before)[0]] if before else [None]
            assert got[i] in latest, i


def test_many_sources(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 9), f"s{r.randint(0, 700):04d}") for i in range(2500)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = {x["source"]: x for x in got}
    total = sum(x["size"] for x in got)
    assert len(got) == 2500 and abs(sum(x["target"] for x in by.values()) - 1.5 * total) < 1e-6 * total
    assert all(x["target"] <= 2 * x["source_size"] + 1e-9 for x in by.values())
    taken = {s: sum(x["taken"] for x in got if x["source"] == s) for s in by}
    assert all(abs(taken[s] - by[s]["target"]) <= 9 for s in by)


def test_long_urls(spark):
    pages = spark.createDataFrame([(1, "http://" + "a" * 70_000 + ".org/" + "b" * 200_000), (2, "http://x.com/fr/" + "c" * 300_000)], "page_id long, url string")
    got = {x["page_id"]: x for x in url_reputation.host_reputation(pages, spark.createDataFrame([], "id long, bad int"), RULES).collect()}
    assert got[1]["rule"] == "org/" and len(got[1]["path"]) == 200_001 and got[2]["rule"] == "com/fr/"
