"""The operators as queries over the test tables, with the parameters they have in production, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bottomk, decontam, hard_negatives, lattice_lm, merkle, mixing, quality, revisit, simhash, token_counts, token_pack, url_reputation, weak_rules
from .common import lower_ascii, materialize, remainder_of_id, small_batches

RULES = tuple(url_reputation.Rule(a, t) for a, t in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")))
#: Ids of word_bpe_49k.json.
VOCABULARY = 49_408
END = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes are the labels of the document with the page's number: bad if its quality is 0 or it is toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return url_reputation.host_reputation(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes, RULES)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tables are stored; the counts come from what is stored."""
    tables = token_counts.prefix_tables(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    counts = token_counts.budget_counts(materialize(tables, "prefix-tables"), budget=512)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "n_fit")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    scored = quality.score(docs, model, cut=0.3)
    return scored.select("doc_id", (remainder_of_id("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, most=3)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=1.5, max_epochs=2)


def op6_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, manifest = token_pack.write_packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=END, vocabulary=VOCABULARY)
    return token_pack.read_packed(path, manifest)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """A crawl log of the pages: of each page a full response (but for every fifth) and a later revisit, whose validators
    match, differ (every eleventh) or are missing in part (every seventh has no etag)."""
    p, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    modified = F.concat(F.lit("m"), (F.col("page_id") % 4).cast("string"))
    pairs = lambda *kv: F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in kv)), lambda x: x["value"].isNotNull()))
    day = lambda c: F.concat(F.lit("d"), c.cast("string"))
    ts, again = p * 10, p * 10 + 1005
    response = pages.filter(p % 5 != 0).select(
        (p * 2).alias("record_id"), "url", ts.alias("ts"), F.lit("response").alias("kind"),
        pairs(("Content-Type", F.lit("text/html")), ("Date", day(ts)), ("ETag", tag), ("Last-Modified", modified)).alias("headers"),
    )
    etag = F.when(p % 7 == 0, None).when(p % 11 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    later = pages.select(
        (p * 2 + 1).alias("record_id"), "url", again.alias("ts"), F.lit("revisit").alias("kind"),
        pairs(("Date", day(again)), ("ETag", etag), ("Last-Modified", modified), ("X-Cache", F.lit("hit"))).alias("headers"),
    )
    return response.unionByName(later)


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisit.resolve_revisits(crawl_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    pairs = F.transform(F.map_entries("headers"), lambda e: F.concat(lower_ascii(e["key"]), F.lit("="), e["value"]))
    return out.withColumn("headers", F.array_join(F.array_sort(pairs), ";"))


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), folds=5, held_out=1)


def op10_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.edited_pairs(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides vec_id the label is the next one, which makes mistaken labels."""
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(given.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


def op12_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_url_reputation, op2_token_counts, op3_quality, op4_simhash, op5_mixing, op6_token_pack, op7_decontamination, op8_revisits,
        op9_lattice_lm, op10_bottomk, op11_hard_negatives, op12_weak_rules, op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}


_TWO_LABELS = ", ".join(f"'{s}'" for s in url_reputation.TWO_LABEL_SUFFIXES)


def _level(name: str, source: str) -> str:
    """CTEs of one level of the reputation: prior strength and posterior of `source` (n, k, parent)."""
    return f"""
  {name}_s AS (SELECT sum(pow(k - n * parent, 2) / (n * parent * (1 - parent))) AS x2, count(*) AS i, sum(n - 1) AS e FROM {source} WHERE n > 0),
  {name}_m AS (SELECT CASE WHEN coalesce(e, 0) = 0 OR x2 - i <= 0 THEN 1000.0 ELSE least(greatest(1 / ((x2 - i) / e) - 1, 1.0), 1000.0) END AS m FROM {name}_s),
  {name} AS (SELECT *, m * parent + k AS a, m * (1 - parent) + n - k AS b FROM {source}, {name}_m)"""


OP1_SQL = rf"""
WITH u AS (SELECT page_id, url, substr(url, instr(url, '://') + 3) AS rest, instr(url, '://') > 0 AS ok FROM pages),
  p AS (SELECT page_id, CASE WHEN ok THEN translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
  bad AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
  h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k FROM p LEFT JOIN bad USING (page_id) GROUP BY host),
  h1 AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS bare, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l FROM h0),
  h2 AS (SELECT *, array_to_string(l[greatest(len(l) - 1, 1):], '.') AS two, array_to_string(l[greatest(len(l) - 2, 1):], '.') AS three FROM h1),
  h3 AS (SELECT host, n, k, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare WHEN two IN ({_TWO_LABELS}) THEN three ELSE two END AS domain,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN '' WHEN two IN ({_TWO_LABELS}) THEN two ELSE l[len(l)] END AS suffix FROM h2),
  g AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS parent FROM h3),
  s0 AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k, any_value(parent) AS parent FROM h3, g GROUP BY suffix),{_level("s", "s0")},
  d0 AS (SELECT d.*, s.a / (s.a + s.b) AS parent FROM (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h3 GROUP BY 1, 2) d JOIN s USING (suffix)),{_level("d", "d0")},
  t0 AS (SELECT h3.*, d.a / (d.a + d.b) AS parent FROM h3 JOIN d USING (suffix, domain)),{_level("t", "t0")},
  r AS (SELECT host, n AS n_labelled, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM t),
  m AS (SELECT p.*, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > 0.3 THEN 'block' ELSE 'allow' END AS verdict,
  n_labelled, round(bound, 6) AS bound FROM m JOIN r USING (host)
"""

OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('42:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
  z AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
  w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM z),
  o AS (SELECT *, coalesce(sum(cap) OVER b, 0)::BIGINT AS caps_before, (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::BIGINT AS weight_left, (sum(source_size) OVER ())::BIGINT AS total FROM w
    WINDOW b AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  l AS (SELECT *, (total * 1500 - caps_before * 1000)::DOUBLE / 1000.0 / weight_left AS level FROM o),
  c AS (SELECT *, level * weight >= cap AS clamped FROM l),
  f AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE (SELECT max_by(level, -caps_before) FROM c WHERE NOT clamped) * weight END AS target FROM c),
  t AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS whole FROM f),
  b AS (SELECT source, substr(digest, 1, 3) AS bin, sum(size)::BIGINT AS bin_size FROM d GROUP BY 1, 2),
  k AS (SELECT *, coalesce(sum(bin_size) OVER (PARTITION BY source ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM b),
  e AS (SELECT d.doc_id, d.source, d.size, d.digest, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest, k.before, k.bin_size, k.bin
    FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source AND substr(d.digest, 1, 3) = k.bin JOIN t ON d.source IS NOT DISTINCT FROM t.source),
  q AS (SELECT *, sum(size) OVER (PARTITION BY source, bin ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to FROM e),
  r AS (SELECT *, whole + CASE WHEN rest <= 0 THEN 0 WHEN before + bin_size <= rest THEN 1 WHEN before >= rest THEN 0 WHEN before + up_to - size / 2 <= rest THEN 1 ELSE 0 END AS repetitions FROM q)
SELECT doc_id, source, size, source_size, target, repetitions, repetitions * size AS taken FROM r
"""

OP8_SQL = r"""
WITH c AS (SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS url FROM pages),
  s AS (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(.*)$', 1) AS rest FROM c),
  v AS (SELECT *, regexp_replace(translate(regexp_extract(rest, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', '') AS host,
    regexp_extract(rest, '^[^/?]*([^?]*)', 1) AS path, regexp_extract(rest, '^[^?]*[?](.*)$', 1) AS query FROM s),
  n AS (SELECT page_id, '"' || md5(coalesce(html, '')) || '"' AS tag, 'm' || (page_id % 4) AS modified,
    CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(query, '&')), '&') END ELSE url END AS canonical_url FROM v),
  f AS (SELECT page_id * 2 AS response_id, page_id * 10 AS response_ts, canonical_url, tag, modified FROM n WHERE page_id % 5 <> 0),
  r AS (SELECT page_id * 2 + 1 AS record_id, page_id * 10 + 1005 AS ts, canonical_url, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 11 = 0 THEN '"other"' ELSE 'W/' || tag END AS etag, modified FROM n),
  j AS (SELECT r.*, f.response_id, f.response_ts, f.tag AS _tag, f.modified AS _modified, row_number() OVER (PARTITION BY r.record_id ORDER BY f.response_ts DESC NULLS LAST, f.response_id DESC) AS k
    FROM r LEFT JOIN f ON r.canonical_url = f.canonical_url AND f.response_ts < r.ts),
  o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = _tag THEN 'resolved' ELSE 'mismatch' END
    WHEN modified = _modified THEN 'resolved' ELSE 'mismatch' END AS status FROM j WHERE k = 1)
SELECT record_id, canonical_url, ts, response_id, response_ts, status,
  CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=d' || ts || ';etag=' || coalesce(etag, _tag) || ';last-modified=' || modified
    ELSE 'date=d' || ts || CASE WHEN etag IS NULL THEN '' ELSE ';etag=' || etag END || ';last-modified=' || modified || ';x-cache=hit' END AS headers FROM o
"""


def oracle_sql() -> dict[str, str]:
    """Of the operators that SQL can express; the tests hold the others against brute force."""
    return {"op1_url_reputation": OP1_SQL, "op5_mixing": OP5_SQL, "op8_revisits": OP8_SQL}
