"""One line to many: splitters and option readers, as arrays that a generator expands."""

from __future__ import annotations

from ..functions import lines as L
from ..functions import questions as Q
from ..functions import text as T
from ..functions.dialect import Dialect

CUT = "\x01"
# Fixed value: labels that part a line where several stand in it.
LABELS = ("First Name", "Last Name", "Middle Name", "Full Name", "Patient Name", "Date of Birth", "Zip Code", "Home Phone", "Work Phone", "Cell Phone", "Marital Status", "Email", "Employer", "Occupation", "Relationship", "SSN", "City", "State", "Phone", "Address", "Date")


def cut(d: Dialect, x: str, pattern: str, to: str) -> str:
    """Array of the parts of x, parted where the mark in `to` (CUT) is put."""
    return d.filter(d.map(d.split(d.sub(x, pattern, to), CUT), "p", d.trim("p")), "p", "p <> ''")


def labelled_parts(d: Dialect, x: str) -> str:
    """`A: __ B: __` cut before each label with a colon, if it has two and is no question."""
    parts = cut(d, x, r"([_)\]] *)([A-Z][A-Za-z ]{1,30}:)", f"$1{CUT}$2")
    whole = f"array({x})" if d.spark else f"[{x}]"
    return f"CASE WHEN {d.count(x, ':')} >= 2 AND length({x}) >= 30 AND NOT {d.contains(x, '?')} THEN {parts} ELSE {whole} END"


def question_parts(d: Dialect, x: str) -> str:
    """Two questions with boxes on one line, wide blanks between them."""
    return cut(d, x, r"(\][^\[\]]*?) {4,}([A-Z][A-Za-z ?]*[:?]? *\[)", f"$1{CUT}$2")


def known_label_parts(d: Dialect, x: str) -> str:
    """Cut before each known label that follows a gap."""
    return cut(d, x, rf"([_ ]{{2,}}|\t)({'|'.join(LABELS)})\b", f"$1{CUT}$2")


def slash_parts(d: Dialect, x: str) -> str:
    """`Apt/Unit/Suite____` as three labels."""
    head = d.first(x, r"^([A-Za-z]+(/[A-Za-z]+)+) *_{3,}", 1)
    return d.filter(d.split(head, "/"), "p", "p <> ''")


def blank_parts(d: Dialect, x: str) -> str:
    """`City____ State____` as labels."""
    return d.map(d.all(x, r"([A-Za-z][A-Za-z#]*( [A-Za-z#]+)?) *_{3,}", 1), "p", d.trim("p"))


def subfields(d: Dialect, x: str) -> str:
    """`Phone: Mobile ___ Home ___` as "Mobile Phone", "Home Phone"; nothing for lines with boxes or other labels."""
    label = d.trim(d.first(x, "^([A-Za-z]+):", 1))
    names = d.all(d.first(x, "^[A-Za-z]+:(.*)$", 1), "([A-Z][A-Za-z]+) *_+", 1)
    none = "cast(array() as array<string>)" if d.spark else "[]::VARCHAR[]"
    return f"CASE WHEN {label} <> '' AND {d.count(x, ':')} = 1 AND NOT {d.contains(x, '[')} AND {d.size(names)} >= 2 THEN {d.map(names, 'n', f'concat(n, {d.lit(" ")}, {label})')} ELSE {none} END"


def colon_fields(d: Dialect, x: str) -> str:
    """Labels with a colon and what stands after them, as `label|value`."""
    return d.map(d.all(x, r"([A-Z][A-Za-z ]{1,30}: *[^:]*?)( {2,}|\t|$)", 1), "p", d.trim("p"))


def options(d: Dialect, x: str) -> str:
    """Names after boxes, cleaned, all of them."""
    names = d.map(d.all(x, r"\[[ xX]?\] *([^\[\]]+)", 1), "o", T.clean_token(d, "o"))
    return d.filter(names, "o", "o <> ''")


def option_label(d: Dialect, x: str) -> str:
    """What stands before the first box, without its colon."""
    return d.sub(d.trim(d.first(x, r"^([^\[]*)\[", 1)), "[:? ]+$", "")


def yes_no_prompts(d: Dialect, x: str) -> str:
    """Prompts before `[ ] Yes [ ] No`."""
    return d.distinct(d.filter(d.map(d.all(x, r"([^\[\]]+?)\[ *\] *Yes *\[ *\] *No", 1, ci=True), "p", d.trim("p")), "p", "length(p) > 1"))


def yes_no_follow_up(d: Dialect, x: str) -> str:
    """A follow-up asked for in the line of its boxes, after them."""
    return d.has(x, rf"({L.BOX}).*(if (yes|so)|explain|please list)", ci=True)


def tab_parts(d: Dialect, x: str) -> str:
    """Cells of a tabbed signature line."""
    return d.filter(d.map(d.split(x, "\t"), "p", d.trim("p")), "p", "p <> ''")


def inline_choices(d: Dialect, x: str) -> str:
    """Choices in words: `(Y or N)`, `(M/F)`, `circle one: a / b / c`."""
    listed = d.map(d.split(d.first(x, r"circle one:? *([^()]*)", 1, ci=True), "/"), "c", d.trim("c"))
    pick = [(d.has(x, r"\b(yes|y) *(or|/) *(no|n)\b", ci=True), d.array(["Yes", "No"])), (d.has(x, r"\bm *(or|/) *f\b", ci=True), d.array(["Male", "Female"])), (d.has(x, r"circle one", ci=True), d.filter(listed, "c", "c <> ''"))]
    return d.case(pick, "cast(array() as array<string>)" if d.spark else "[]::VARCHAR[]")


def orphan_pairs(d: Dialect, x: str, following: str) -> str:
    """The labels of the line below a line of bare boxes, as many as there are boxes."""
    labels = d.filter(d.map(d.split(following, r" {3,}|\t"), "p", d.trim("p")), "p", "p <> ''")
    none = "cast(array() as array<string>)" if d.spark else "[]::VARCHAR[]"
    return f"CASE WHEN {L.has_orphan_boxes(d, x)} AND {following} IS NOT NULL THEN {d.slice(labels, 1, d.count(x, L.BOX))} ELSE {none} END"


def fill_in_label(d: Dialect, x: str, before: str, following: str) -> str:
    """Label of a line that is mostly a blank: its own words, else the line below, else the line above, by length."""
    own = T.clean_title(d, x)
    mostly = f"{d.count(x, '_')} >= 5 AND {d.count(x, '_')} * 2 >= length({x})"
    short = lambda y: f"length({d.trim(y)}) BETWEEN 2 AND 40 AND NOT {d.contains(y, '_')}"
    return d.case([(f"NOT ({mostly})", "NULL"), (f"{own} <> ''", own), (short(following), d.trim(following)), (short(before), d.trim(before))], "NULL")


def parenthetical_label(d: Dialect, x: str) -> str:
    """`____(print name)` is a field named in the parentheses."""
    return d.first(x, r"_{3,} *\(([^)]{3,40})\)", 1)


def generated(d: Dialect, source: str, array: str, name: str = "part") -> str:
    """The rows that a splitter makes of the lines of `source`, numbered within their line."""
    return d.exploded(f"(SELECT doc_id, pos, line FROM ({source}) g) g", array, "doc_id, pos", name, pos="sub")


def known_parts(d: Dialect, x: str) -> str:
    """A line that asks a known question beside others, in parts: what stands before and after the question of sex or gender,
    and that with its choice; what stands before a question of marital status or contact, and that; an insurance number and a social security number. Null for other lines."""
    join = lambda *a: f"concat({', '.join(a)})" if d.spark else f"list_concat({', '.join(a)})"
    rest = lambda y: d.filter(labelled_parts(d, y), "r_", "r_ <> ''")
    upto = lambda seg: d.let(d.trim(f"substr({x}, 1, cast(instr({x}, {seg}) as int) - 1)"), "head_", join(rest("head_"), Q.only(d, seg)))
    partly = lambda seg: f"{seg} <> '' AND {seg} <> {d.trim(x)}"
    both = d.array(["Insurance ID Number: ____", "SSN: ____"])
    tail = d.let(Q.preferred_contact(d, x), "contact_", f"CASE WHEN {partly('contact_')} THEN {upto('contact_')} END")
    tail = d.let(Q.marital_status(d, x), "marital_", f"CASE WHEN {partly('marital_')} THEN {upto('marital_')} ELSE {tail} END")
    after = lambda seg: d.let(d.trim(f"substr({x}, cast(instr({x}, {seg}) as int) + length({seg}))"), "tail_", rest("tail_"))
    sex = d.let(Q.sex_segment(d, x), "sex_", f"CASE WHEN {partly('sex_')} THEN {join(upto('sex_'), after('sex_'))} ELSE {tail} END")
    asked = d.has(x, r"\b(sex|gender|marital|circle\s+one|preferred)\b", ci=True)
    numbers = f"{d.has(x, r'\b(ssn|social +security)\b', ci=True)} AND {d.size(Q.id_and_ssn(d, x))} > 0"
    return d.case([(numbers, both), (asked, sex)], "NULL")


def field_parts(d: Dialect, x: str) -> str:
    """The fields of a line, by the first splitter that makes several of it; else the line. A splitter runs once, and only
    where a plain search finds what it looks for."""
    if_any = lambda gate, parts: f"CASE WHEN {gate} THEN {d.let(parts, 'parts_', f'CASE WHEN {d.size("parts_")} > 0 THEN parts_ END')} END"
    tries = [
        f"CASE WHEN {d.contains(x, chr(9))} THEN CASE WHEN {L.is_tabulated_signature(d, x)} THEN {tab_parts(d, x)} END END",
        if_any(f"{d.contains(x, '_')} AND {d.has(x, '^[A-Za-z]+:.*_')}", subfields(d, x)), if_any(d.contains(x, " " * 10), Q.spaced_labels(d, x)),
        if_any(f"{d.contains(x, '___')} AND {d.has(x, '^[A-Za-z]+/.*___')}", slash_parts(d, x)),
        f"CASE WHEN NOT ({d.contains(x, '    ')} AND {L.has_box(d, x)}) THEN {known_parts(d, x)} END",
        f"CASE WHEN {d.contains(x, '    ')} AND {L.has_box(d, x)} THEN {d.let(question_parts(d, x), 'parts_', f'CASE WHEN {d.size("parts_")} > 1 THEN parts_ END')} END",
        f"CASE WHEN NOT {L.has_box(d, x)} AND {d.has(x, '(__|  |' + chr(9) + ')(' + '|'.join(LABELS) + ')')} THEN {d.let(known_label_parts(d, x), 'parts_', f'CASE WHEN {d.size("parts_")} > 1 THEN parts_ END')} END",
        d.case([(f"{d.contains(x, ':')} AND {d.has(x, r'\bif +[^:]{5,40}:', ci=True)}", Q.conditional_parts(d, x)), (f"{d.contains(x, '    ')} AND {L.has_box(d, x)}", Q.boxed_parts(d, x)), (d.has(x, "^[A-Za-z#]+ ?[A-Za-z#]+$"), Q.compound_label(d, x))], "NULL"),
    ]
    return f"coalesce({', '.join(tries)}, {labelled_parts(d, x)})"


def alike_lists(d: Dialect, lists: str, least: float = 0.25) -> str:
    """a, b, jaccard: pairs of distinct lists of options (column `options`, `|` between) that are alike by `least` or more.

    Lists meet by the rarest of their options only: two that are alike share one of the first n - ceil(least * n) + 1 in the
    order of frequency, so an option that most lists have brings nothing together, and no pair is lost or met twice.
    """
    names = d.filter(d.distinct(d.map(d.split("options", r"[|]"), "o", T.option_name(d, "o"))), "o", "o <> ''")
    sets = f"SELECT options, {names} AS names FROM ({lists}) l"
    items = d.exploded(f"({sets}) s", "names", "options, names", "name", pos="k")
    counted = f"SELECT *, count(*) OVER (PARTITION BY name) AS times FROM ({items}) i"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY options ORDER BY times, name) AS place FROM ({counted}) c"
    first = f"SELECT options, names, name FROM ({ranked}) r WHERE place <= {d.size('names')} - ceil({least} * {d.size('names')}) + 1"
    met = f"SELECT DISTINCT a.options AS a, b.options AS b, a.names AS a_names, b.names AS b_names FROM ({first}) a JOIN ({first}) b ON a.name = b.name AND a.options < b.options"
    common = d.size(d.common("a_names", "b_names"))
    jaccard = f"{common} * 1.0 / ({d.size('a_names')} + {d.size('b_names')} - {common})"
    return f"SELECT a, b, cast(round({jaccard}, 6) as double) AS jaccard FROM ({met}) m WHERE {jaccard} >= {least}"


def options_text(d: Dialect, x: str) -> str:
    """Names of the options after boxes, or else of the choices in words, `|` between them; a follow-up (`If yes, explain`) is
    no part of the last one."""
    boxed = d.join(options(d, d.sub(d.sub(x, r"(\].*)\bif (yes|so|no)\b.*$", "$1", ci=True), r"\|", "/")), "|")
    in_words = d.has(x, r"\b(yes|y|m) *(or|/)|circle one", ci=True)
    return f"CASE WHEN {L.has_box(d, x)} THEN {boxed} WHEN {in_words} THEN {d.join(inline_choices(d, x), '|')} ELSE '' END"
