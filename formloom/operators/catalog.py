"""Template catalogue: matching of titles by key, title, alias, contained alias and similarity, each a staged join."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields as D
from ..functions import questions as Q
from ..functions import similar as S
from ..functions import text as T
from ..functions.dialect import Dialect
from . import known as K

#: A small catalogue of templates (key, title, section, options with `|` between) and of aliases (phrase, key), in order.
TEMPLATES = (
    ("full_name", "Name", "Patient Information", ""), ("first_name", "First Name", "Patient Information", ""), ("last_name", "Last Name", "Patient Information", ""), ("date_of_birth", "Date of Birth", "Patient Information", ""),
    ("mobile_phone", "Mobile Phone", "Patient Information", ""), ("home_phone", "Home Phone", "Patient Information", ""), ("work_phone", "Work Phone", "Patient Information", ""), ("zipcode", "Zip Code", "Patient Information", ""),
    ("gender", "Gender", "Patient Information", "Male|Female"), ("country", "Country", "Patient Information", ""), ("insurance_id_number", "Insurance ID Number", "Insurance", ""), ("insurance_company", "Insurance Company", "Insurance", ""),
    ("taking_medications", "Are you taking any medications", "Medical History", "Yes|No"), ("had_conditions", "Do you have any of the following conditions", "Medical History", "Diabetes|Asthma|Heart Disease|Stroke"), ("signature", "Signature", "Signature", ""), ("date_signed", "Date Signed", "Signature", ""),
)
#: What those say of their controls (type, input type, hint, whether several may be chosen, condition as JSON).
CONTROLS = {
    "full_name": ("input", "name", "", "", ""), "date_of_birth": ("date", "past", "", "", ""), "mobile_phone": ("input", "phone", "", "", ""), "home_phone": ("input", "phone", "", "", ""), "zipcode": ("input", "zip", "", "", ""),
    "gender": ("radio", "", "", "false", ""), "insurance_id_number": ("input", "text", "As on your card", "", ""), "taking_medications": ("radio", "", "", "false", ""), "had_conditions": ("dropdown", "", "", "true", ""),
    "signature": ("block_signature", "", "", "", ""), "date_signed": ("date", "past", "", "", '[{"key":"signature","value":"signed"}]'),
}
ALIASES = (
    ("patient name", "full_name"), ("printed name", "full_name"), ("dob", "date_of_birth"), ("birthdate", "date_of_birth"), ("cell phone", "mobile_phone"), ("mobile", "mobile_phone"), ("zip", "zipcode"), ("sex", "gender"),
    ("policy number", "insurance_id_number"), ("member id", "insurance_id_number"), ("subscriber id", "insurance_id_number"), ("primary insurance", "insurance_company"), ("date", "date_signed"), ("signature of guardian", "signature"),
)


#: What a template says of its control: columns of a catalogue, empty where it says nothing.
CONTROL = ("type", "input_type", "hint", "multi", "condition")
CHOICES = "('radio', 'checkbox', 'dropdown')"


def values(d: Dialect, rows: tuple[tuple[str, ...], ...], names: str) -> str:
    """A small table with the place of each row; its size is that of the source, so it is broadcast."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join([*map(d.lit, r), str(i)]) + ')' for i, r in enumerate(rows))}) v({names}, ord)"


class Catalog(NamedTuple):
    """Queries of a catalogue: templates (key, title, section, options, ord) and aliases (phrase, key, ord)."""

    templates: str
    aliases: str


def templates(d: Dialect, own: Catalog | None = None) -> str:
    """Templates of a catalogue; without one those fixed here."""
    source = own.templates if own else values(d, tuple((*t, *CONTROLS.get(t[0], ("",) * 5)) for t in TEMPLATES), f"key, title, section, options, {', '.join(CONTROL)}")
    return f"SELECT key AS t_key, {T.match_text(d, 'title')} AS t_title, section AS t_section, options AS t_options, type AS t_type, input_type AS t_input, hint AS t_hint, multi AS t_multi, condition AS t_if, ord FROM ({source}) t"


def aliases(d: Dialect, own: Catalog | None = None) -> str:
    source = own.aliases if own else values(d, ALIASES, "phrase, key")
    return f"SELECT {T.match_text(d, 'phrase')} AS alias, key AS a_key, {T.tokens(d, 'phrase')} AS a_tokens, ord FROM ({source}) a"


def register(known: DataFrame, phrases: DataFrame, prefix: str | None = None) -> Catalog:
    """A catalogue of DataFrames: templates (key, title, section, options, ord, and what there is of CONTROL), aliases (alias, key). The first of equal
    keys stays. Its views have a name of their own, so several catalogues in a session don't meet."""
    prefix = prefix or f"_catalog_{uuid.uuid4().hex}"
    parts = ["title", "section", "options", "ord", *(c for c in CONTROL if c in known.columns)]
    once = known.groupBy("key").agg(F.min_by(F.struct(*parts), "ord").alias("t")).select("key", "t.*")
    text = lambda c, other="": (F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in once.columns else F.lit(other)).alias(c)
    once.select("key", text("title"), text("section", "General"), text("options"), *map(text, CONTROL), "ord").createOrReplaceTempView(f"{prefix}_templates")
    phrases.select(F.col("alias").alias("phrase"), "key", F.lit(0).alias("ord")).filter("phrase IS NOT NULL").createOrReplaceTempView(f"{prefix}_aliases")
    return Catalog(f"SELECT * FROM {prefix}_templates", f"SELECT * FROM {prefix}_aliases")


FIELD_COLUMNS = "doc_id, pos, sub, key, title, section, options"
#: What best() looks at, and what it finds.
MATCHED, FOUND = ("key", "title", "section", "options"), ("norm", "stage", "t_key", "t_section", "reason", "score")
REASONS = ("key_exact", "key_base_exact", "title_exact", "alias_exact", "alias_contains")


def overlap(d: Dialect, a: str, b: str) -> str:
    """Jaccard similarity of two lists of options (`|` between); 1 if either is empty."""
    names = lambda x: d.filter(d.distinct(d.map(d.split(x, r"\|"), "o", T.option_name(d, "o"))), "o", "o <> ''")
    common, sizes = d.size(d.common(names(a), names(b))), f"{d.size(names(a))} + {d.size(names(b))}"
    return f"CASE WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' THEN 1.0 ELSE {common} * 1.0 / greatest({sizes} - {common}, 1) END"


def lookups(d: Dialect, own: Catalog | None = None) -> str:
    """What titles and keys are looked up by: probe (`stage|value`), the template, and the tokens that must be there too."""
    t, a = templates(d, own), aliases(d, own)
    none = "cast(array() as array<string>)" if d.spark else "[]::VARCHAR[]"
    cols = "t.t_key, t.t_section, t.t_options"
    rows = [f"SELECT concat('{i}|', t.t_key) AS probe, {i} AS stage, {cols}, t.ord, {none} AS needs FROM ({t}) t" for i in (1, 2)]
    rows.append(f"SELECT concat('3|', t.t_title) AS probe, 3 AS stage, {cols}, t.ord, {none} AS needs FROM ({t}) t")
    rows.append(f"SELECT concat('4|', a.alias) AS probe, 4 AS stage, {cols}, a.ord, {none} AS needs FROM ({a}) a JOIN ({t}) t ON a.a_key = t.t_key")
    rows.append(f"SELECT concat('5|', {d.item('a.a_tokens', 1)}) AS probe, 5 AS stage, {cols}, a.ord, a.a_tokens AS needs FROM ({a}) a JOIN ({t}) t ON a.a_key = t.t_key")
    return " UNION ALL ".join(rows)


def best(d: Dialect, source: str, own: Catalog | None = None, columns: str = FIELD_COLUMNS) -> str:
    """Every field once, with the template that the first stage that knows one gives it (t_key, reason, score), or nulls.

    key_exact 1, key_base 0.98, title_exact 0.95, alias_exact 0.96, alias_contains 0.93, the last three times the overlap of
    options; 0.05 more in the template's own section, 0.1 less if one of both is insurance. Titles over 120 characters or 15
    words without options are matched exactly or not at all; so are questions how one heard of the practice.

    The fields are read once: each is looked up by all its probes (both keys, the title, its tokens) in one join with the
    lookups, whose size is the catalogue's and which Spark broadcasts if that allows, and one window picks the first stage.
    In Spark the fields are counted before, and what documents share is matched once and looked up (see known).
    """
    if not d.spark:
        return staged_best(d, source, own, columns)
    once = f"SELECT row_number() OVER (ORDER BY {', '.join(MATCHED)}) AS doc_id, 0 AS pos, 0 AS sub, * FROM ({K.frequent(source, MATCHED)}) k"
    table = K.stored(d, f"SELECT {', '.join((*MATCHED, *FOUND))} FROM ({staged_best(d, once, own)}) b", 1)
    given = f"SELECT true AS k_hit, {', '.join(f'{c} AS k_{c}' for c in (*MATCHED, *FOUND))} FROM ({table}) t"
    known = f"SELECT /*+ BROADCAST(k) */ f.*, k.* FROM ({source}) f LEFT JOIN ({given}) k ON {' AND '.join(f'f.{c} = k.k_{c}' for c in MATCHED)}"
    carried = ", ".join(["k_hit", *(f"k_{c}" for c in FOUND)])
    found = ", ".join(f"CASE WHEN k_hit THEN k_{c} ELSE {c} END AS {c}" for c in FOUND)
    return f"SELECT {columns}, {found} FROM ({staged_best(d, known, own, f'{columns}, {carried}', 'coalesce(k_hit, false)')}) b"


def staged_best(d: Dialect, source: str, own: Catalog | None = None, columns: str = FIELD_COLUMNS, settled: str = "") -> str:
    """best() by its stages. settled: whether a field is left alone."""
    f = f"SELECT {columns}, {T.match_text(d, 'title')} AS norm, {T.tokens(d, 'title')} AS tokens FROM ({source}) f"
    if settled:
        f = f"SELECT {columns}, CASE WHEN NOT {settled} THEN {T.match_text(d, 'title')} END AS norm, CASE WHEN NOT {settled} THEN {T.tokens(d, 'title')} END AS tokens FROM ({source}) f"
    probes = d.map("tokens", "t", "concat('5|', t)")
    exact = ", ".join(("concat('1|', key)", f"concat('2|', {D.strip_scope(d, 'key')})", "concat('3|', norm)", "concat('4|', norm)"))
    exact = f"array({exact})" if d.spark else f"[{exact}]"
    all_ = f"concat({exact}, {probes})" if d.spark else f"list_concat({exact}, {probes})"
    if settled:
        all_ = f"CASE WHEN {settled} THEN array(cast(NULL as string)) ELSE {all_} END"
    rows = d.exploded(f"({f}) w", all_, f"{columns}, norm, tokens", "probe", pos="k")
    own_ = ", ".join(f"r.{c.strip()}" for c in columns.split(","))
    long_ = "(length(norm) > 120 OR " + d.words("norm") + " > 15) AND coalesce(options, '') = ''"
    parent = d.has("title", r"\b(parent|guardian|mother|father)", ci=True)
    fits = f"""(m.stage < 4 OR NOT (m.t_key = 'ssn' AND {parent.replace('title', 'r.title')})) AND (m.stage < 5 OR (NOT ({long_}) AND {d.size(d.common('m.needs', 'r.tokens'))} = {d.size('m.needs')}
      AND (m.t_section <> 'Insurance' OR r.section = 'Insurance') AND NOT {Q.is_hear_about(d, 'r.title')}))"""
    context = "CASE WHEN stage < 3 OR coalesce(section, '') = '' THEN 0 WHEN section = t_section THEN 0.05 WHEN (section = 'Insurance') <> (t_section = 'Insurance') THEN -0.1 ELSE 0 END"
    base = "CASE stage WHEN 1 THEN 1.0 WHEN 2 THEN 0.98 WHEN 3 THEN 0.95 WHEN 4 THEN 0.96 ELSE 0.93 END"
    shared = f"CASE WHEN stage < 3 THEN 1.0 ELSE {overlap(d, 'options', 't_options')} END"
    reason = d.case([(f"stage = {i}", f"'{r}'") for i, r in enumerate(REASONS, 1)], "NULL")
    return f"""SELECT {columns}, norm, stage, t_key, t_section, {reason} AS reason, CASE WHEN stage IS NOT NULL THEN cast(round({base} * {shared} + {context}, 4) as double) END AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, pos, sub ORDER BY coalesce(stage, 9), ord, t_key) AS n FROM (
    SELECT {own_}, r.norm, r.tokens, CASE WHEN {fits} THEN m.stage END AS stage, CASE WHEN {fits} THEN m.t_key END AS t_key, CASE WHEN {fits} THEN m.t_section END AS t_section, CASE WHEN {fits} THEN m.t_options END AS t_options,
      CASE WHEN {fits} THEN m.ord END AS ord FROM ({rows}) r LEFT JOIN ({lookups(d, own)}) m ON r.probe = m.probe) c) p WHERE n = 1"""


def cascade(d: Dialect, source: str, own: Catalog | None = None) -> str:
    """The fields that have a template."""
    return f"SELECT doc_id, pos, sub, t_key, reason, score FROM ({best(d, source, own)}) b WHERE t_key IS NOT NULL"


def merged(d: Dialect, source: str, own: Catalog | None = None, columns: str = FIELD_COLUMNS) -> str:
    """Fields overlaid on the templates that the exact stages give them."""
    return overlaid(d, best(d, source, own, columns), own, columns)


def coverage(d: Dialect, source: str, own: Catalog | None = None) -> str:
    """Jaccard similarity and coverage of each distinct title and the templates that share a token with it."""
    titles = f"SELECT DISTINCT {T.match_text(d, 'title')} AS norm, {T.tokens(d, 'title')} AS tokens FROM ({source}) f"
    words = d.exploded(f"({titles}) w", "tokens", "norm, tokens", "token", pos="k")
    t = f"SELECT t_key, t_title, {T.tokens(d, 't_title')} AS t_tokens FROM ({templates(d, own)}) t"
    t_words = d.exploded(f"({t}) t", "t_tokens", "t_key, t_tokens", "t_token", pos="k")
    pairs = f"SELECT DISTINCT w.norm, w.tokens, t.t_key, t.t_tokens FROM ({words}) w JOIN ({t_words}) t ON w.token = t.t_token"
    common = d.size(d.common("tokens", "t_tokens"))
    return f"SELECT norm, t_key, cast(round({common} * 1.0 / ({d.size('tokens')} + {d.size('t_tokens')} - {common}), 6) as double) AS jaccard, cast(round({common} * 1.0 / {d.size('t_tokens')}, 6) as double) AS coverage FROM ({pairs}) p"


# What a title never means, however like it is; and the words of keys that a section makes likelier.
NEVER = (
    (r"name.*of +(employer|insurance|company|practice)", ("first_name", "last_name", "middle_name")), (r"employer|company|practice|business", ("first_name", "last_name", "patient_name")),
    (r"relationship", ("first_name", "last_name", "full_name")), (r"group|policy|plan.*number", ("ssn", "patient_id")), (r"mobile|cell", ("home_phone", "work_phone", "fax")),
    (r"home.*phone", ("mobile_phone", "work_phone", "cell_phone")), (r"work.*phone", ("mobile_phone", "home_phone", "cell_phone")),
)
SECTION_BOOSTS = (("insurance", ("insurance", "policy", "group", "member", "subscriber")), ("emergency", ("emergency", "contact", "notify")), ("patient", ("patient", "name", "birth", "address")))


def smart(d: Dialect, source: str, own: Catalog | None = None) -> str:
    """The best template of each distinct title and section by a scorer that knows its context: equal keys 1, titles 0.95,
    aliases 0.9, tokens alike by 0.7 or more up to 0.85; 0.05 more where the section speaks for it; some pairs never match.

    Only a template that shares a key, an alias or a token with a title can score, so pairs meet by equality, not crossed.
    """
    titles = f"SELECT DISTINCT title, section, {T.match_text(d, 'title')} AS norm, {T.catalog_key(d, 'title')} AS slug, {T.tokens(d, 'title')} AS tokens FROM ({source}) f"
    ways = lambda exact, tokens: f"concat(array({exact}), {d.map(tokens, 't', 'concat(' + d.lit('t|') + ', t)')})" if d.spark else f"list_concat([{exact}], {d.map(tokens, 't', 'concat(' + d.lit('t|') + ', t)')})"
    left = d.exploded(f"({titles}) w", ways("concat('k|', slug), concat('a|', norm)", "tokens"), "title, section, norm, slug, tokens", "way", pos="k")
    t = f"SELECT t_key, t_title, t_section, ord, {T.tokens(d, 't_title')} AS t_tokens FROM ({templates(d, own)}) t"
    right = d.exploded(f"({t}) t", ways("concat('k|', t_key)", "t_tokens"), "t_key, t_title, ord, t_tokens", "t_way", pos="k")
    named = f"SELECT t.t_key, t.t_title, t.ord, t.t_tokens, concat('a|', a.alias) AS t_way FROM ({aliases(d, own)}) a JOIN ({t}) t ON a.a_key = t.t_key"
    pairs = f"SELECT l.title, l.section, l.norm, l.slug, l.tokens, r.t_key, r.t_title, r.ord, r.t_tokens, max(CASE WHEN {d.starts('l.way', 'a|')} THEN 1 ELSE 0 END) AS by_alias FROM ({left}) l JOIN (SELECT t_key, t_title, ord, t_tokens, t_way FROM ({right}) x UNION ALL SELECT t_key, t_title, ord, t_tokens, t_way FROM ({named}) y) r ON l.way = r.t_way GROUP BY l.title, l.section, l.norm, l.slug, l.tokens, r.t_key, r.t_title, r.ord, r.t_tokens"
    common = d.size(d.common("tokens", "t_tokens"))
    ratio = f"({common} * 1.0 / greatest({d.size('tokens')} + {d.size('t_tokens')} - {common}, 1))"
    never = " OR ".join(f"({d.has('norm', p)} AND t_key IN ({', '.join(map(d.lit, keys))}))" for p, keys in NEVER)
    base = d.case([(never, "0.0"), ("slug = t_key", "1.0"), ("norm = t_title", "0.95"), ("by_alias = 1", "0.9"), (f"{ratio} >= 0.7", f"0.7 + ({ratio} - 0.7) * 0.5")], "0.0")
    boost = d.case([(f"{d.contains('lower(section)', s)} AND {d.any_of('t_key', words)}", "0.05") for s, words in SECTION_BOOSTS], "0.0")
    return f"""SELECT title, section, t_key, score FROM (SELECT *, row_number() OVER (PARTITION BY title, section ORDER BY score DESC, ord) AS n FROM (
  SELECT title, section, t_key, ord, cast(round(least(1.0, base + CASE WHEN base > 0 THEN {boost} ELSE 0 END), 4) as double) AS score FROM (SELECT *, {base} AS base FROM ({pairs}) p) b) s WHERE score >= 0.7) r WHERE n = 1"""


# Sections where a lower score is enough, and words that count more where both sides have them.
LENIENT = r"medical|health|patient|insurance|emergency"
KEYWORDS = ("physician", "hospitalized", "medication", "allergy", "surgery")


def fuzzy(d: Dialect, titles: str, own: Catalog | None = None) -> str:
    """title, section, options, t_key, t_section, score, verdict (`fuzzy`, `near`, `none`) of each title (title, section,
    options, norm; distinct) that is near a template.

    0.45 Jaccard of tokens and 0.45 Ratcliff-Obershelp decide which template; 0.1 times the overlap of options, the context
    and 0.05 for each keyword on both sides are added. Of templates of over three tokens 0.8 must be covered, else 0.65; a
    score of 0.82, or 0.85 in sections that aren't about the patient, is a match, from 0.75 it is near.
    Only pairs with enough coverage by shared tokens are compared letter by letter.
    """
    near = f"SELECT norm AS n_norm, t_key AS n_key, jaccard, coverage FROM ({coverage(d, f'SELECT title FROM ({titles}) t', own)}) c"
    enough = f"CASE WHEN {d.size(T.tokens(d, 't_title'))} > 3 THEN 0.8 ELSE 0.65 END"
    pairs = f"SELECT n_norm, jaccard, t.* FROM ({near}) n JOIN ({templates(d, own)}) t ON n.n_key = t.t_key WHERE coverage >= {enough}"
    alike = f"SELECT p.*, cast(0.45 as double) * jaccard + cast(0.45 as double) * r.ratio AS alike FROM ({pairs}) p JOIN ({S.ratios(d, f'SELECT n_norm AS a, t_title AS b FROM ({pairs}) q')}) r ON p.n_norm = r.a AND p.t_title = r.b"
    best_ = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n_norm ORDER BY alike DESC, ord, t_key) AS n FROM ({alike}) a) b WHERE n = 1"
    context = "CASE WHEN coalesce(section, '') = '' THEN 0.0 WHEN section = t_section THEN 0.05 WHEN (section = 'Insurance') <> (t_section = 'Insurance') THEN -0.1 ELSE 0.0 END"
    boost = " + ".join(f"CASE WHEN {d.contains('norm', k)} AND {d.contains('t_title', k)} THEN 0.05 ELSE 0.0 END" for k in KEYWORDS)
    score = f"cast(round(alike + cast(0.1 as double) * ({overlap(d, 'options', 't_options')}) + ({context}) + {boost}, 6) as double)"
    scored = f"SELECT title, section, options, t_key, t_section, {score} AS score FROM ({titles}) t JOIN ({best_}) b ON t.norm = b.n_norm"
    verdict = d.case([(f"score >= CASE WHEN {d.has('lower(t_section)', LENIENT)} THEN 0.82 ELSE 0.85 END", "'fuzzy'"), ("score >= 0.75", "'near'")], "'none'")
    return f"SELECT title, section, options, t_key, t_section, score, {verdict} AS verdict FROM ({scored}) s"


def unknown(d: Dialect, exact: str) -> str:
    """The distinct titles of best() that no exact stage knows, for fuzzy()."""
    return f"SELECT DISTINCT title, section, coalesce(options, '') AS options, norm FROM ({exact}) e WHERE t_key IS NULL AND norm <> '' AND NOT {Q.is_hear_about(d, 'title')}"


def match(d: Dialect, exact: str, own: Catalog | None = None, columns: str = FIELD_COLUMNS) -> str:
    """The whole cascade: the rows of best() (`exact`), and for fields that no stage knows the fuzzy one. One row a field, with
    t_key, reason, score; reason is `near` where a template almost fits, and null without any."""
    near = f"SELECT title AS f_title, section AS f_section, options AS f_options, t_key AS f_key, score AS f_score, verdict FROM ({fuzzy(d, unknown(d, exact), own)}) f WHERE verdict <> 'none'"
    own_ = ", ".join(f"e.{c.strip()}" for c in columns.split(","))
    return f"""SELECT {own_}, e.norm, coalesce(e.t_key, CASE WHEN verdict = 'fuzzy' THEN f_key END) AS t_key, coalesce(e.reason, verdict) AS reason, coalesce(e.score, f_score) AS score
  FROM ({exact}) e LEFT JOIN ({near}) f ON e.t_key IS NULL AND e.title = f.f_title AND e.section = f.f_section AND coalesce(e.options, '') = f.f_options"""


def overlaid(d: Dialect, matched: str, own: Catalog | None = None, columns: str = FIELD_COLUMNS) -> str:
    """Matched fields laid over their templates: a template's key, type and control, part by part, with the field's title and
    section; what the template leaves open is the field's. A scope of the key is put back. Further columns: reused, reason,
    score, hint, multi, needs (the template's condition, as JSON).

    Options are the template's if it has any; the field's, if the template's type or, without one, the field's takes options.
    """
    names = [c.strip() for c in columns.split(",")]
    typed = "coalesce(t_type, '') <> ''"
    kind = f"CASE WHEN {typed} THEN t_type ELSE type END" if "type" in names else "coalesce(t_type, '')"
    options = f"CASE WHEN {typed} AND t_type NOT IN {CHOICES} THEN '' WHEN coalesce(t_options, '') <> '' THEN t_options ELSE options END"
    made = {
        "key": f"CASE WHEN t_key IS NULL THEN key WHEN {d.contains('t_key', '__')} THEN t_key ELSE concat(t_key, {d.first('key', '(__(primary|secondary))$', 1)}) END",
        "section": "CASE WHEN coalesce(section, '') = '' THEN coalesce(k_section, section) ELSE section END", "type": kind, "options": options,
        "n_options": f"CASE WHEN {options} = '' THEN 0 ELSE {d.count(options, '[|]')} + 1 END", "input_type": f"CASE WHEN NOT ({typed}) THEN input_type WHEN t_type = 'input' THEN coalesce(nullif(t_input, ''), input_type, 'text') END",
    }
    known = f"SELECT t_key AS k_key, t_section AS k_section, t_options, t_type, t_input, t_hint, t_multi, t_if FROM ({templates(d, own)}) t"
    shown = ", ".join(f"{made.get(c, c)} AS {c}" if c in made else c for c in names)
    return f"""SELECT {shown}, t_key IS NOT NULL AS reused, reason, score, coalesce(t_hint, '') AS hint, coalesce(t_multi, '') AS multi, coalesce(t_if, '') AS needs
  FROM ({matched}) m LEFT JOIN ({known}) k ON m.t_key = k.k_key"""


def match_log(d: Dialect, source: str, own: Catalog | None = None) -> str:
    """What the matching did, as rows: kind `match`, `near` (a template covers a title by half or more, yet none was taken)
    or `gate` (nothing is near), with the reason, how many fields, and the best coverage."""
    near = f"SELECT norm, max(coverage) AS coverage FROM ({coverage(d, source, own)}) c GROUP BY norm"
    kind = "CASE WHEN b.t_key IS NOT NULL THEN 'match' WHEN n.coverage >= 0.5 THEN 'near' ELSE 'gate' END"
    return f"""SELECT title, section, kind, reason, count(*) AS n, max(coverage) AS coverage FROM (SELECT b.title, b.section, {kind} AS kind, coalesce(b.reason, '') AS reason, coalesce(n.coverage, 0) AS coverage
  FROM ({best(d, source, own)}) b LEFT JOIN ({near}) n ON b.norm = n.norm) l GROUP BY title, section, kind, reason"""
