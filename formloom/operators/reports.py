"""Reports over documents and fields: statistics, rates, histograms, parity, suggestions, subtotals."""

from __future__ import annotations

from ..functions.dialect import Dialect
from . import known as K


def as_json(d: Dialect, key: str, value: str) -> str:
    """Aggregate: a JSON object of keys and numbers, keys in order; nulls are left out."""
    pair = f"""CASE WHEN {key} IS NOT NULL THEN concat('"', {key}, '":', cast({value} as varchar(20))) END"""
    return f"concat('{{', {d.ordered_join(pair, key, ',')}, '}}')"


def stats(d: Dialect, source: str) -> str:
    """Per document: fields, sections, whether it is signed, and counts by type and by section as JSON, in one pass."""
    sets = f"SELECT doc_id, type, section, count(*) AS n FROM ({source}) f GROUP BY GROUPING SETS ((doc_id, type), (doc_id, section))"
    return f"""SELECT doc_id, cast(sum(CASE WHEN type IS NOT NULL THEN n ELSE 0 END) as bigint) AS n_fields, count(section) AS n_sections, max(CASE WHEN type = 'block_signature' THEN 1 ELSE 0 END) = 1 AS has_signature,
  {as_json(d, "type", "n")} AS by_type, {as_json(d, "section", "n")} AS by_section FROM ({sets}) g GROUP BY doc_id"""


def input_sizes(d: Dialect, source: str) -> str:
    """Bytes, characters and lines of each text."""
    size = "octet_length(text)" if d.spark else "strlen(text)"
    return f"SELECT doc_id, cast({size} as bigint) AS n_bytes, cast(length(text) as bigint) AS n_chars, cast({d.count('text', chr(10))} + 1 as bigint) AS n_lines FROM ({source}) t"


def rates(d: Dialect, source: str) -> str:
    """Micro rate, sum over sum, and macro rate, mean of the documents' rates. source: doc_id, reused."""
    per = f"SELECT doc_id, count(*) AS n, {d.count_if('reused')} AS hits FROM ({source}) m GROUP BY doc_id"
    return f"SELECT count(*) AS documents, cast(sum(n) as bigint) AS items, cast(sum(hits) as bigint) AS matched, cast(round(sum(hits) * 100.0 / sum(n), 4) as double) AS micro_rate, cast(round(avg(hits * 100.0 / n), 4) as double) AS macro_rate FROM ({per}) p"


def histogram(d: Dialect, source: str, value: str) -> str:
    """Documents by bucket of a percentage: from 90, 80, 70, 60, 50 and below; with each bucket's share."""
    bucket = d.case([(f"{value} >= {b}", f"'{b}+'") for b in (90, 80, 70, 60, 50)], "'below'")
    return f"SELECT bucket, n, cast(round(n * 100.0 / sum(n) OVER (), 4) as double) AS share FROM (SELECT {bucket} AS bucket, count(*) AS n FROM ({source}) s GROUP BY {bucket}) b"


def extremes(d: Dialect, source: str, value: str, k: int = 5) -> str:
    """The k best and the k worst, ties by doc_id."""
    top = lambda way, name: f"SELECT '{name}' AS side, doc_id, {value} AS value FROM ({source}) s ORDER BY {value} {way}, doc_id LIMIT {k}"
    return f"SELECT * FROM ({top('DESC', 'best')}) a UNION ALL SELECT * FROM ({top('ASC', 'worst')}) b"


def subtotals(d: Dialect, source: str) -> str:
    """Fields in all, by type and by section, in one pass of grouping sets."""
    return f"SELECT type, section, count(*) AS n FROM ({source}) f GROUP BY GROUPING SETS ((), (type), (section))"


def parity(d: Dialect, lines: str, fields: str) -> str:
    """Half the share of reused fields, 0.3 of the capture rate, and 0.2 for signature, date and name."""
    potential = f"SELECT doc_id, sum({d.count('line', r'\[ *\]')}) + sum({d.count('line', '_{3,}')}) AS potential FROM ({lines}) l GROUP BY doc_id"
    got = f"SELECT doc_id, count(*) AS n, {d.count_if('reused')} AS hits, max(CASE WHEN {d.contains('key', 'signature')} THEN 33 ELSE 0 END) + max(CASE WHEN {d.contains('key', 'date')} THEN 33 ELSE 0 END) + max(CASE WHEN {d.contains('key', 'name')} THEN 34 ELSE 0 END) AS flags FROM ({fields}) f GROUP BY doc_id"
    return f"SELECT p.doc_id, n, potential, cast(round(0.5 * hits * 100.0 / n + 0.3 * least(100.0, n * 100.0 / greatest(potential, 1)) + 0.2 * flags, 4) as double) AS parity FROM ({potential}) p JOIN ({got}) g ON p.doc_id = g.doc_id"


def suggestions(d: Dialect, unmatched: str, least: int = 2) -> str:
    """Keys that the catalogue lacks, by how often they occur; five times or more is a high priority."""
    return f"SELECT key, count(*) AS n, min(title) AS title, CASE WHEN count(*) >= 5 THEN 'high' ELSE 'medium' END AS priority FROM ({unmatched}) u GROUP BY key HAVING count(*) >= {least}"


def indicators(d: Dialect, source: str) -> str:
    """What a document's text promises: boxes, blanks, dates (three at most), signatures (two at most), long blocks."""
    s = lambda p, ci=False: f"sum({d.count('line', p, ci)})"
    return f"SELECT doc_id, cast({s(r'\[ *\]')} as bigint) AS boxes, cast({s('_{3,}')} as bigint) AS blanks, cast(least({s('date', True)}, 3) as bigint) AS dates, cast(least({s('signature', True)}, 2) as bigint) AS signatures, {d.count_if('length(line) > 80')} AS long_lines FROM ({source}) l GROUP BY doc_id"


def improvement(d: Dialect, best: str) -> str:
    """Change of the rates from a catalogue without aliases to the whole one, over all fields in one pass of the cascade."""
    per = f"SELECT count(*) AS items, {d.count_if('stage <= 3')} AS base, {d.count_if('stage IS NOT NULL')} AS current FROM ({best}) b"
    rate = lambda x: f"{x} * 100.0 / greatest(items, 1)"
    return f"""SELECT items, cast(base as bigint) AS base_matched, cast(current as bigint) AS matched, cast(round({rate('current')} - {rate('base')}, 4) as double) AS micro_delta,
  cast(round((current - base) * 100.0 / nullif(base, 0), 4) as double) AS micro_change FROM ({per}) p"""


# Kinds of patterns that a report looks for, with the context that it shows and how many of each.
PATTERNS = (("date", 20, 3), ("signature", 20, 2), ("name", 30, 2))


def missing_patterns(d: Dialect, lines: str, fields: str) -> str:
    """doc_id, kind, place, snippet: contexts of dates, signatures and names in documents whose fields name none. Lines and
    fields are read once for all kinds."""
    word = lambda k: rf"\b{k}\b"
    captured = f"SELECT doc_id, {', '.join(f'max(CASE WHEN {d.has("title", word(k), ci=True)} THEN 1 ELSE 0 END) AS has_{k}' for k, *_ in PATTERNS)} FROM ({fields}) f GROUP BY doc_id"
    items = ", ".join(f"CASE WHEN {d.has('line', word(k), ci=True)} THEN '{k}' END" for k, *_ in PATTERNS)
    kinds = d.filter(f"array({items})" if d.spark else f"[{items}]", "k", "k IS NOT NULL")
    rows = d.exploded(f"(SELECT * FROM ({lines}) l WHERE length({d.trim('line')}) >= 3) l", kinds, "doc_id, pos, line", "kind", pos="i")
    snippet = d.case([(f"kind = '{k}'", d.trim(d.first("line", rf"[^.]{{0,50}}\b{k}\b[^.]{{0,{after}}}", 0, ci=True))) for k, after, _ in PATTERNS], "''")
    have, most = d.case([(f"kind = '{k}'", f"coalesce(has_{k}, 0)") for k, *_ in PATTERNS], "0"), d.case([(f"kind = '{k}'", str(n)) for k, _, n in PATTERNS], "0")
    return f"""SELECT doc_id, kind, place, snippet FROM (SELECT doc_id, kind, {snippet} AS snippet, row_number() OVER (PARTITION BY doc_id, kind ORDER BY pos) AS place, {most} AS most
  FROM (SELECT r.doc_id, r.pos, r.line, r.kind, {have.replace('kind', 'r.kind').replace('has_', 'c.has_')} AS captured FROM ({rows}) r LEFT JOIN ({captured}) c ON r.doc_id = c.doc_id) j WHERE captured = 0) n WHERE place <= most"""


def detailed(d: Dialect, merged: str) -> str:
    """Per document: fields, matched ones, the rate, and the titles of those that weren't, in order."""
    titles = d.ordered_join("CASE WHEN NOT reused THEN title END", d.place("pos", "sub"), "; ")
    return f"SELECT doc_id, count(*) AS n, cast({d.count_if('reused')} as bigint) AS matched, cast(round({d.count_if('reused')} * 100.0 / count(*), 4) as double) AS rate, {titles} AS unmatched FROM ({merged}) m GROUP BY doc_id"


def performance(d: Dialect, merged: str, sizes: str, templates: str) -> str:
    """A report in parts (part, label, value, share): the dictionary against what was found, statistics over all documents, the
    distribution of match rates, the five best and worst documents, and fields by type and by section with their shares.

    merged: doc_id, type, section, key, reused; sizes: doc_id, n_bytes, n_chars, n_lines; templates: t_key, t_section.
    """
    per = f"SELECT doc_id, count(*) AS n, {d.count_if('reused')} AS hits, count(DISTINCT section) AS sections FROM ({merged}) m GROUP BY doc_id"
    docs = f"SELECT p.*, s.n_bytes, s.n_chars, s.n_lines, cast(round(p.hits * 100.0 / p.n, 4) as double) AS rate FROM ({per}) p JOIN ({sizes}) s ON p.doc_id = s.doc_id"
    docs = K.stored(d, docs) if d.spark else d.stage(docs)  # read four times, with other columns each

    def told(part: str, source: str, values: dict[str, str]) -> str:
        """One row of aggregates as a row for each label."""
        row = f"SELECT {', '.join(f'cast({e} as double) AS v{i}' for i, e in enumerate(values.values()))} FROM ({source}) t"
        label = d.case([(f"place = {i}", d.lit(n)) for i, n in enumerate(values)], "''")
        numbers = ", ".join(f"v{i}" for i in range(len(values)))
        rows = d.exploded(f"({row}) r", f"array({numbers})" if d.spark else f"[{numbers}]", "1 AS one", "value", pos="place")
        return f"SELECT '{part}' AS part, {label} AS label, cast(round(value, 4) as double) AS value, cast(NULL as double) AS share FROM ({rows}) v"

    known = f"SELECT count(*) AS fields, count(DISTINCT t_section) AS sections FROM ({templates}) t"
    used = f"SELECT count(*) AS items, {d.count_if('reused')} AS hits, count(DISTINCT CASE WHEN reused THEN key END) AS keys FROM ({merged}) m"
    dictionary = told("dictionary", f"SELECT * FROM ({known}) k CROSS JOIN ({used}) u", {"fields": "fields", "sections": "sections", "found": "items", "matched": "hits", "not in it": "items - hits", "used keys": "keys", "match rate": "hits * 100.0 / greatest(items, 1)"})
    overall = told("overall", docs, {
        "documents": "count(*)", "fields": "sum(n)", "matched": "sum(hits)", "match rate": "sum(hits) * 100.0 / sum(n)", "mean rate": "avg(rate)", "fields a document": "avg(n)", "sections a document": "avg(sections)",
        "kilobytes": "sum(n_bytes) / 1024.0", "characters": "sum(n_chars)", "lines": "sum(n_lines)", "lines a document": "avg(n_lines)",
    })
    bands = f"SELECT 'rates' AS part, bucket AS label, cast(n as double) AS value, share FROM ({histogram(d, docs, 'rate')}) h"
    ends = f"SELECT side AS part, cast(doc_id as varchar(400)) AS label, value, cast(NULL as double) AS share FROM ({extremes(d, docs, 'rate')}) e"
    of = lambda c: f"SELECT '{c}' AS part, {c} AS label, cast(n as double) AS value, cast(round(n * 100.0 / sum(n) OVER (), 4) as double) AS share FROM (SELECT {c}, count(*) AS n FROM ({merged}) m GROUP BY {c}) c"
    return " UNION ALL ".join((dictionary, overall, bands, ends, of("type"), of("section")))


# What makes a line look like a field.
INDICATORS = (r"_{3,}", r"\[ *\]", r"^ *[A-Z][^:]{1,60}: *$")


def text_coverage(d: Dialect, lines: str, fields: str) -> str:
    """Per document: lines that look like fields, fields, and their ratio."""
    t = d.trim("line")
    likely = f"SELECT doc_id, {d.count_if(f'length({t}) >= 3 AND {d.any_match(t, INDICATORS)}')} AS potential FROM ({lines}) l GROUP BY doc_id"
    got = f"SELECT doc_id, count(*) AS actual FROM ({fields}) f GROUP BY doc_id"
    return f"SELECT p.doc_id, cast(potential as bigint) AS potential, coalesce(actual, 0) AS actual, cast(round(CASE WHEN potential = 0 THEN 1.0 ELSE coalesce(actual, 0) * 1.0 / potential END, 6) as double) AS coverage FROM ({likely}) p LEFT JOIN ({got}) g ON p.doc_id = g.doc_id"


def subfields_missing(d: Dialect, lines: str, fields: str) -> str:
    """Titles that `Label: Part ___ Part ___` lines promise and no field of the document has, by an anti join."""
    from . import splits

    wanted = d.exploded(f"(SELECT doc_id, pos, line FROM ({lines}) l) g", splits.subfields(d, "line"), "doc_id, pos", "title", pos="sub")
    return f"SELECT w.doc_id, w.pos, w.title FROM ({wanted}) w LEFT JOIN (SELECT DISTINCT doc_id, lower(title) AS got FROM ({fields}) f) f ON w.doc_id = f.doc_id AND lower(w.title) = f.got WHERE f.got IS NULL"
