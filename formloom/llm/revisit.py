"""WARC: resolution of not-modified revisits, by an as-of join to the latest earlier full response of the same URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, lower_ascii

#: Headers that a not-modified response may update in the stored one; all others stay as stored.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "set-cookie", "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without default port, fragment and empty query, parameters in order; null stays null.

    `http` and `https` are one. What has no `://` is only trimmed.
    """
    url = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(.*)$", 1)
    host = F.regexp_replace(lower_ascii(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"^[^?]*[?](.*)$", 1)
    ordered = F.array_join(F.array_sort(F.split(query, "&")), "&")
    full = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), ordered)))
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), full).otherwise(url)


def folded(headers: Column) -> Column:
    """Headers as sorted entries (name, value) with names in lower case; of names that differ in case only the first by
    code point stays. Null has no entries."""
    entry = lambda x: F.struct(F.lower(x["key"]).alias("name"), x["key"].alias("own"), x["value"].alias("value"))
    entries = F.array_sort(F.transform(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")), entry))
    first = lambda all_: F.filter(all_, lambda x, i: (i == 0) | (F.get(all_, i - 1)["name"] != x["name"]))
    return F.transform(let(entries, first), lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value")))


def value_of(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda x: x["name"] == name), 0)["value"]


def merged_headers(stored: Column, sent: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """The stored response's entries, with those of the revisit that it may update."""
    may = F.filter(sent, lambda x: x["name"].isin(*permitted) & x["value"].isNotNull())
    names = F.transform(may, lambda x: x["name"])
    return F.concat(F.filter(stored, lambda x: ~F.array_contains(names, x["name"])), may)


def resolve_revisits(records: DataFrame, *, bins: int = 64, dense: int = 4_000_000) -> DataFrame:
    """Resolve each revisit to the latest full response of its canonical URL that is strictly earlier.

    records: record_id, url, ts (a long), kind (`response` or `revisit`; other kinds and null are left out), headers
    (map<string,string>, may be null), and any other columns, which are ignored.

    Returns a row for each revisit: record_id, canonical_url, ts, response_id, response_ts, status, headers. status is
    `resolved`; `mismatch`, if both have an etag and they differ (weakly compared), or, without two etags, both have a
    last-modified date and they differ; `unverified`, if no validator is on both sides; `missing`, if there is no earlier
    response (null url or ts included). headers (names in lower case) are merged where the status is `resolved` or
    `unverified`, else the revisit's own. Of names that differ in case only the first by code point counts. Of responses
    with one ts the highest record_id counts; of repeated responses with one record_id that with the least validators and
    headers. Repeated revisits are resolved each; an empty table gives an empty result.

    A URL's timeline is cut into bins of time, `bins` or one for each `dense` records: each bin finds its own latest
    responses, and one row for each URL and bin carries the last response of a bin to the later ones. So a URL with a
    third of all records is `bins` tasks' work. Only the revisits' headers go through the windows, the responses' join last.
    """
    own = records.filter("kind in ('response', 'revisit')").select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "ts", "kind", "headers")
    span = own.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count("*").alias("n")).first()
    bins = max(bins, span["n"] // dense)
    lo, width = span["lo"] or 0, max(1, -(-((span["hi"] or 0) - (span["lo"] or 0) + 1) // bins))
    r = own.withColumn("bin", F.floor((F.col("ts") - lo) / width).cast("int"))
    full = (F.col("kind") == "response") & F.col("ts").isNotNull() & F.col("canonical_url").isNotNull()
    brief = F.when(full, F.struct("ts", "record_id"))

    order = Window.partitionBy("canonical_url", "bin").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    carried = r.withColumn("sent", F.when(F.col("kind") == "revisit", folded(F.col("headers")))).drop("headers")
    inner = carried.withColumn("found", F.max(brief).over(order)).filter("kind = 'revisit'")
    ends = r.filter(full).groupBy("canonical_url", "bin").agg(F.max(F.struct("ts", "record_id")).alias("last"))
    asked = r.filter((F.col("kind") == "revisit") & F.col("ts").isNotNull() & F.col("canonical_url").isNotNull()).select("canonical_url", "bin").distinct()
    spots = ends.unionByName(asked.withColumn("last", F.lit(None).cast(ends.schema["last"].dataType))).groupBy("canonical_url", "bin").agg(F.max("last").alias("last"))
    carry = spots.withColumn("carried", F.last("last", ignorenulls=True).over(Window.partitionBy("canonical_url").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
    carry = carry.select("canonical_url", "bin", "carried")
    asof = inner.join(carry, ["canonical_url", "bin"], "left").select("record_id", "canonical_url", "ts", "sent", F.coalesce("found", "carried").alias("at"))

    kept = F.struct(etag_of(F.col("entries")).alias("etag"), value_of(F.col("entries"), "last-modified").alias("modified"), F.col("entries").alias("entries"))
    stored = r.filter(full).withColumn("entries", folded(F.col("headers"))).select(F.col("record_id").alias("response_id"), F.col("ts").alias("response_ts"), F.col("canonical_url").alias("_url"), kept.alias("stored"))
    stored = stored.groupBy("response_id", "response_ts", "_url").agg(F.min("stored").alias("stored"))
    on = (asof["at.record_id"] == stored["response_id"]) & (asof["at.ts"] == stored["response_ts"]) & (asof["canonical_url"] == stored["_url"])
    j = asof.join(stored, on, "left").withColumns({"etag": etag_of(F.col("sent")), "modified": value_of(F.col("sent"), "last-modified")})
    tags = F.col("etag").isNotNull() & F.col("stored.etag").isNotNull()
    dates = F.col("modified").isNotNull() & F.col("stored.modified").isNotNull()
    status = (
        F.when(F.col("response_id").isNull(), "missing")
        .when(tags, F.when(F.col("etag") == F.col("stored.etag"), "resolved").otherwise("mismatch"))
        .when(dates, F.when(F.col("modified") == F.col("stored.modified"), "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    j = j.withColumn("status", status)
    headers = F.when(F.col("status").isin("resolved", "unverified"), merged_headers(F.col("stored.entries"), F.col("sent"))).otherwise(F.col("sent"))
    return j.select("record_id", "canonical_url", "ts", "response_id", "response_ts", "status", F.map_from_entries(headers).alias("headers"))


def etag_of(entries: Column) -> Column:
    """The etag without its mark of weakness."""
    return F.regexp_replace(value_of(entries, "etag"), "^W/", "")
