"""Documents as ordered lines: splitting, blocks, repeats, header scrubbing, soft wraps, sections."""

from __future__ import annotations

from ..functions import lines as L
from ..functions import questions as Q
from ..functions import text as T
from ..functions.dialect import Dialect
from . import known as K
from . import parser

OVER = "OVER (PARTITION BY doc_id ORDER BY pos)"


def lines(d: Dialect, source: str, key: str = "doc_id", text: str = "text") -> str:
    """doc_id, pos, line. One line for an empty text; documents are dealt once, by doc_id, and stay so for all windows."""
    return d.exploded(f"(SELECT {key} AS doc_id, {text} AS text FROM {source}) s", d.split("text", r"\n"), "doc_id", "line")


def around(d: Dialect, source: str) -> str:
    """Each line with its neighbours, and how many lines its document has."""
    return f"""SELECT doc_id, pos, line, lag(line) {OVER} AS before, lag(line, 2) {OVER} AS before2, lag(line, 3) {OVER} AS before3, lead(line) {OVER} AS following,
  count(*) OVER (PARTITION BY doc_id) AS total FROM ({source}) l"""


def blocks(d: Dialect, source: str) -> str:
    """Non-blank lines with the number of their block, counted by blank lines before."""
    return f"""SELECT doc_id, pos, line, block FROM (SELECT doc_id, pos, line, sum(CASE WHEN {d.trim("line")} = '' THEN 1 ELSE 0 END) {OVER} AS block FROM ({source}) l) b
  WHERE {d.trim("line")} <> ''"""


def block_summary(d: Dialect, source: str) -> str:
    """Blocks with the hits that tell a practice's address block from form content."""
    form = d.has("line", FORM_LABELS, ci=True)
    return f"""SELECT *, n_lines >= 3 AND (streets >= 2 OR practices >= 1) AND labels < 3 AS is_address FROM (
  SELECT doc_id, block, count(*) AS n_lines, {d.count_if(d.has("line", L.STREET, ci=True))} AS streets, {d.count_if(d.has("line", L.PRACTICE, ci=True))} AS practices, {d.count_if(form)} AS labels
  FROM ({blocks(d, source)}) b GROUP BY doc_id, block) s"""


def repeated(d: Dialect, source: str, least: int = 3, most: int = 80) -> str:
    """Short lines that a document has at least `least` times: its running headers and footers."""
    t = d.squeeze("line")
    return f"SELECT doc_id, {t} AS norm, count(*) AS n FROM ({source}) l WHERE {t} <> '' AND length({t}) <= {most} GROUP BY doc_id, {t} HAVING count(*) >= {least}"


# Practice headers, notices and page numbers that aren't form content.
JUNK = (r"^page +[0-9]+", r"\bcontinued on back side\b|\brev *[0-9]{1,2} */ *[0-9]{2}\b|^(<<<|>>>)$|\bOC[0-9]+\b")
PRACTICE_WORDS = r"\b(dental|care|center|clinic|office|practice)\b"
PRACTICE_HEADER = (r"\b(dental|dentistry|orthodontics|family|cosmetic|implant)\b", r"\b(suite|ste|ave|avenue|rd|road|st|street|blvd)\b", r"@|phone|tel|fax|[0-9]{3}[-. ]?[0-9]{3}[-. ]?[0-9]{4}")
FORM_LABELS = r"\b((last|first|patient) name|birth date|dob|address|city|state|zip( code)?|phone|email|gender|marital|emergency|ssn|insurance) *:"


def junk_rules(d: Dialect, s: str = "norm") -> list[str]:
    return [*(d.has(s, j, ci=True) for j in JUNK), f"{d.count(s, L.CITY_STATE_ZIP)} >= 2", f"length({s}) > 80 AND {d.count(s, PRACTICE_WORDS, ci=True)} >= 2", f"{d.count(s, r'\b[0-9]{5}\b')} >= 2"]


def early_junk(d: Dialect, s: str = "norm") -> str:
    """What is junk among a document's first lines."""
    return f"length({s}) > 40 AND {d.matches(s, PRACTICE_HEADER, ci=True)} >= 2"


def scrubbed(d: Dialect, source: str) -> str:
    """Lines without address blocks, repeats, page numbers, practice headers and notices. The lines are read once: repeats
    and blocks are counted by windows within the document."""
    junk = [*junk_rules(d), f"pos < 20 AND {early_junk(d)}"]
    of_block = lambda p, name: f"sum(CASE WHEN {d.has('line', p, ci=True)} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, block) AS {name}"
    counted = f"""SELECT doc_id, pos, line, norm, count(*) OVER (PARTITION BY doc_id, norm) AS times, count(*) OVER (PARTITION BY doc_id, block) AS n_lines,
    {of_block(L.STREET, "streets")}, {of_block(L.PRACTICE, "practices")}, {of_block(FORM_LABELS, "labels")} FROM (SELECT *, {d.squeeze("line")} AS norm FROM ({blocks(d, source)}) b) k"""
    address = "(n_lines >= 3 AND (streets >= 2 OR practices >= 1) AND labels < 3)"
    return f"SELECT doc_id, pos, line FROM ({counted}) c WHERE NOT (times >= 3 AND length(norm) <= 80) AND NOT {address} AND NOT ({' OR '.join(f'({j})' for j in junk)})"


def gathered_options(d: Dialect, source: str) -> str:
    """Lines of options, joined to the prompt above them: `Allergic to?`, `[ ] Latex`, `- Sulfa`, `[ ] Iodine  [ ] Metals` is
    one line."""
    several = f"{d.has('line', f'^ *({L.BOX})')} AND {d.count('line', L.BOX)} >= 2"
    option = f"coalesce({Q.bullet_option(d, 'line')}, CASE WHEN {several} THEN line END)"
    prompt = lambda x: f"(coalesce({x}, '') <> '' AND NOT {L.has_box(d, x)} AND ({d.has(x, '[?:] *$')} OR {d.has(x, 'following', ci=True)}))"
    part = f"CASE WHEN option IS NULL THEN line WHEN {L.has_box(d, 'line')} THEN {d.trim('line')} ELSE concat('[ ] ', option) END"
    return f"""SELECT doc_id, min(pos) AS pos, {d.ordered_join("part", "pos", " ")} AS line FROM (
    SELECT doc_id, pos, {part} AS part, sum(CASE WHEN option IS NOT NULL AND (before_option IS NOT NULL OR {prompt("before")}) THEN 0 ELSE 1 END) {OVER} AS island FROM (
      SELECT *, lag(option) {OVER} AS before_option, lag(line) {OVER} AS before FROM (SELECT doc_id, pos, line, {option} AS option FROM ({source}) l) o) p) i GROUP BY doc_id, island"""


def prepared(d: Dialect, source: str, counted: str = "") -> str:
    """Lines as fields are read from them: scrubbed, unwrapped, with the options below a prompt in its line, garbled boxes and
    glyphs mended. counted: the frequent lines, if they are known already (see known)."""
    mended = T.restore_ligatures(d, T.normalize_glyphs(d, "line"))
    if d.spark:
        of = lambda p: f"coalesce(cast({d.has('line', p, ci=True)} as int), 0)"
        rules = {"bare": d.trim("line"), "norm": d.squeeze("line"), "street": of(L.STREET), "practice": of(L.PRACTICE), "label": of(FORM_LABELS), "mended": mended}
        steps = [rules, {"junk": " OR ".join(f"({j})" for j in junk_rules(d)), "junk_early": early_junk(d)}, wrap_rules(d, "mended")]
        known = K.with_rules(d, source, ["line"], steps, counted)
        wrapped = K.stored(d, unwrapped(d, f"SELECT * FROM ({scrubbed_known(known)}) s"))
        return f"SELECT doc_id, pos, line FROM ({parser.questions(d, wrapped)}) p"
    clean = f"SELECT doc_id, pos, {mended} AS line FROM ({scrubbed(d, source)}) s"
    return f"SELECT doc_id, pos, line FROM ({parser.questions(d, f'SELECT doc_id, pos, line FROM ({soft_wraps(d, clean)}) w')}) p"


def scrubbed_known(source: str) -> str:
    """scrubbed() of lines that have what its rules make of them."""
    total = lambda c: f"sum({c}) OVER (PARTITION BY doc_id, block)"
    blocked = f"SELECT *, sum(CASE WHEN bare = '' THEN 1 ELSE 0 END) {OVER} AS block FROM ({source}) l"
    counted = f"""SELECT *, count(*) OVER (PARTITION BY doc_id, norm) AS times, count(*) OVER (PARTITION BY doc_id, block) AS n_lines, {total("street")} AS streets, {total("practice")} AS practices, {total("label")} AS labels
    FROM ({blocked}) b WHERE bare <> ''"""
    return f"SELECT * FROM ({counted}) c WHERE NOT (times >= 3 AND length(norm) <= 80) AND NOT (n_lines >= 3 AND (streets >= 2 OR practices >= 1) AND labels < 3) AND NOT (junk OR (pos < 20 AND junk_early))"


def wrap_rules(d: Dialect, x: str) -> dict[str, str]:
    """What soft_wraps() has to know of a line, as the one before (`w_end`, `w_boxes`) and as the one behind."""
    a, b = d.sub(x, r"[ \t]+$", ""), d.trim(x)
    return {
        "w_some": f"{d.trim(x)} <> ''", "w_end": f"substr({a}, length({a}), 1)", "w_boxes": d.has(a, r"/ *\[ *\] *(Yes|No) *(\[ *\] *(Yes|No) *)?$", ci=True),
        "w_own": f"{L.is_heading(d, b)} OR {d.has(b, r'^([-*•]|\[)')} OR {d.has(b, rf'^if +(yes|no|so)\b.*(:|__|{L.BOX})', ci=True)}",
        "w_small": d.has(b, r"^[a-z(]|^(and|or|if|but|then|with|of|for|to)\b") + " OR " + d.has(f"lower({b})", r"^(and|or|if|but|then|with|of|for|to)\b"), "w_low": d.has(b, "^[a-z(]"), "w_part": d.sub(b, "[- ]+$", ""),
    }


def unwrapped(d: Dialect, source: str) -> str:
    """soft_wraps() of lines that have their wrap_rules(); doc_id, pos and line."""
    before = ", ".join(f"lag({c}) {OVER} AS b_{c}" for c in ("w_some", "w_end", "w_boxes"))
    joins = "b_w_some IS NOT NULL AND b_w_some AND w_some AND NOT w_own AND (b_w_end IN ('-', '/') OR (b_w_end NOT IN ('.', ':', ';', '?', '!') AND w_small) OR (b_w_boxes AND w_low))"
    return f"""SELECT doc_id, min(pos) AS pos, {d.ordered_join("w_part", "pos", " ")} AS line FROM (SELECT *, sum(CASE WHEN {joins} THEN 0 ELSE 1 END) {OVER} AS island FROM (SELECT *, {before} FROM ({source}) l) j) i GROUP BY doc_id, island"""


def soft_wraps(d: Dialect, source: str) -> str:
    """Lines joined to those that the page's width parted: gaps and islands over a flag that the neighbours decide. A follow-up
    with something to fill (`If yes, ...: ____`) is a line of its own."""
    a, b = d.sub("before", r"[ \t]+$", ""), d.trim("line")
    end = f"substr({a}, length({a}), 1)"
    small = d.has(b, r"^[a-z(]|^(and|or|if|but|then|with|of|for|to)\b") + " OR " + d.has(f"lower({b})", r"^(and|or|if|but|then|with|of|for|to)\b")
    boxes = d.has(a, r"/ *\[ *\] *(Yes|No) *(\[ *\] *(Yes|No) *)?$", ci=True)
    joins = f"""before IS NOT NULL AND {d.trim("before")} <> '' AND {b} <> '' AND NOT {L.is_heading(d, b)} AND NOT {d.has(b, r'^([-*•]|\[)')} AND NOT {d.has(b, rf'^if +(yes|no|so)\b.*(:|__|{L.BOX})', ci=True)}
    AND ({end} IN ('-', '/') OR ({end} NOT IN ('.', ':', ';', '?', '!') AND ({small})) OR ({boxes} AND {d.has(b, '^[a-z(]')}))"""
    return f"""SELECT doc_id, island, min(pos) AS pos, count(*) AS n_lines, {d.ordered_join("part", "pos", " ")} AS line FROM (
    SELECT doc_id, pos, {d.sub(d.trim("line"), "[- ]+$", "")} AS part, sum(CASE WHEN joined THEN 0 ELSE 1 END) {OVER} AS island FROM (
      SELECT doc_id, pos, line, {joins} AS joined FROM (SELECT *, lag(line) {OVER} AS before FROM ({source}) l) p) j) i GROUP BY doc_id, island"""


def sections(d: Dialect, source: str) -> str:
    """Each line with its section: the last heading's, but General never ends Medical or Dental History. And the scope of
    insurance that the last heading set."""
    last = lambda x: d.last(x, "PARTITION BY doc_id ORDER BY pos")
    scope = f"CASE WHEN heading IS NOT NULL THEN CASE WHEN {d.has('line', 'primary insurance', ci=True)} THEN 'primary' WHEN {d.has('line', 'secondary insurance', ci=True)} THEN 'secondary' ELSE '' END END"
    return f"""SELECT doc_id, pos, line, heading, CASE WHEN named IN ('Medical History', 'Dental History') THEN named WHEN general > coalesce(named_at, -1) THEN 'General' ELSE coalesce(named, 'General') END AS section,
    coalesce(scope, '') AS scope FROM (
    SELECT doc_id, pos, line, heading, {last("CASE WHEN heading <> 'General' THEN heading END")} AS named, {last("CASE WHEN heading <> 'General' THEN pos END")} AS named_at,
      {last("CASE WHEN heading = 'General' THEN pos END")} AS general, {last(scope)} AS scope FROM (
      SELECT doc_id, pos, line, CASE WHEN {L.is_heading_in_place(d, "line", "following", "pos")} THEN {T.section_name(d, "line")} END AS heading FROM (
        SELECT doc_id, pos, line, lead(line) {OVER} AS following FROM ({source}) l) n) h) s"""


def section_rules(d: Dialect) -> dict[str, str]:
    """What sections_of() has to know of a line by itself."""
    named = d.case([(d.has("line", "primary insurance", ci=True), "'primary'"), (d.has("line", "secondary insurance", ci=True), "'secondary'")], "''")
    low = f"lower({d.trim('line')})"
    return {
        "is_heading": L.is_heading(d, "line"), "if_underlined": L.is_heading_beside(d, "line", "true"), "if_early": L.is_heading_beside(d, "line", "false", "true"), "if_late": L.is_heading_beside(d, "line", "false", "false"),
        "underlines": d.has("line", r"^ *[-=_]{3,} *$"), "name": T.section_name(d, "line"), "new_scope": named, "n_fields": d.matches(low, FIELD_SIGNS), "n_info": info_signs(d, low),
    }


def sections_of(d: Dialect, source: str, further: str) -> str:
    """sections() of lines that have their section_rules(), with further columns."""
    last = lambda x: d.last(x, "PARTITION BY doc_id ORDER BY pos")
    beside = f"CASE WHEN coalesce(lead(underlines) {OVER}, false) THEN if_underlined WHEN pos < 3 THEN if_early ELSE if_late END"
    return f"""SELECT doc_id, pos, line, heading, CASE WHEN named IN ('Medical History', 'Dental History') THEN named WHEN general > coalesce(named_at, -1) THEN 'General' ELSE coalesce(named, 'General') END AS section,
    coalesce(scope, '') AS scope, {further} FROM (
    SELECT doc_id, pos, line, heading, {last("CASE WHEN heading <> 'General' THEN heading END")} AS named, {last("CASE WHEN heading <> 'General' THEN pos END")} AS named_at,
      {last("CASE WHEN heading = 'General' THEN pos END")} AS general, {last("CASE WHEN heading IS NOT NULL THEN new_scope END")} AS scope, {further} FROM (
      SELECT doc_id, pos, line, CASE WHEN is_heading OR beside THEN name END AS heading, new_scope, {further} FROM (SELECT *, {beside} AS beside FROM ({source}) l) n) h) s"""


# What tells fields, and what tells sheets that only inform.
FIELD_SIGNS = (r": *_{2,}", r"^ *\[ *\]", r"\b(name|address|phone|email|date|signature|birth|ssn):")
INFO_SIGNS = (r"^(congratulations|welcome|thank you|important|note|remember)", r"\bhooray\b|beautiful smile|party.*over")


def is_information_sheet(d: Dialect) -> str:
    """Over a document's lines, as windows: at most one sign of a field and two of information in the first 30 of five lines
    or more, or none and one in a document of fewer than 20 lines."""
    low = f"lower({d.trim('line')})"
    return informs(d, d.matches(low, FIELD_SIGNS), info_signs(d, low))


def info_signs(d: Dialect, low: str) -> str:
    return f"{d.matches(low, INFO_SIGNS)} + CASE WHEN {d.contains(low, 'retainer')} AND {d.any_of(low, ('#', 'guide'))} THEN 2 ELSE 0 END"


def informs(d: Dialect, n_fields: str, n_info: str) -> str:
    """is_information_sheet() of the numbers of signs that a line has."""
    over = "OVER (PARTITION BY doc_id)"
    total = lambda e: f"sum(CASE WHEN pos < 30 THEN {e} ELSE 0 END) {over}"
    fields, info = total(n_fields), total(n_info)
    n = f"count(*) {over}"
    return f"({n} >= 5 AND (({fields} <= 1 AND {info} >= 2) OR ({n} < 20 AND {fields} = 0 AND {info} >= 1)))"


def information_sheets(d: Dialect, source: str) -> str:
    """Documents that only inform."""
    return f"SELECT DISTINCT doc_id FROM (SELECT doc_id, {is_information_sheet(d)} AS informs FROM ({source}) l) i WHERE informs"
