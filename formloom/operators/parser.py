"""The parser's state as folds over a document: options found below their prompt, follow-ups under their question."""

from __future__ import annotations

from ..functions import lines as L
from ..functions import questions as Q
from ..functions.dialect import Dialect
from . import known as K

#: Lines that may stand between a prompt and its options.
REACH = 3
#: Ends of a state: a place after all lines, and one before them.
AFTER, NOWHERE = "9000000000", "-1"
# Fixed value: how a line begins that only says how to answer.
GUIDANCE = r"^[(]|\b(check|mark|circle|select|choose|tick) +(all|any|one|those|the|each|clearly|below)|\bplease +(check|mark|circle|select|choose|tick|list)|\ball that apply\b|^(if any|leave blank)"


def is_guidance(d: Dialect, x: str) -> str:
    """A short line that only says how to answer: no box, no blank to fill, and nothing after a colon."""
    return f"(NOT {L.has_box(d, x)} AND NOT {d.contains(x, '__')} AND length({x}) <= 80 AND {d.has(d.trim(x), GUIDANCE, ci=True)} AND NOT {d.has(x, ': *[^ ]')})"


def line_kinds(d: Dialect, source: str) -> str:
    """doc_id, pos, line, part (a line of options as boxes) and kind: blank, option, prompt, guidance or other.

    A line that begins with a box or a bullet is an option, unless it is a question of its own (`[ ] Yes, send me ...`);
    a prompt has no box and ends in `?` or `:`, or speaks of the following; a label with a blank to fill is neither.
    """
    several = f"{d.has('line', f'^ *({L.BOX})')} AND {d.count('line', L.BOX)} >= 2"
    option = f"CASE WHEN NOT {Q.is_boxed_question(d, 'line')} THEN coalesce({Q.bullet_option(d, 'line')}, CASE WHEN {several} THEN line END) END"
    prompt = f"NOT {L.has_box(d, 'line')} AND NOT {d.contains('line', '__')} AND ({d.has('line', '[?:] *$')} OR {d.has('line', 'following', ci=True)})"
    kind = d.case([(f"{d.trim('line')} = ''", "'blank'"), ("option IS NOT NULL", "'option'"), (is_guidance(d, "line"), "'guidance'"), (prompt, "'prompt'")], "'other'")
    part = f"CASE WHEN option IS NULL THEN line WHEN {L.has_box(d, 'line')} THEN {d.trim('line')} ELSE concat('[ ] ', option) END"
    if d.spark:  # once for each line that documents share
        return f"SELECT doc_id, pos, line, part, kind FROM ({K.with_rules(d, source, ['line'], [{'option': option}, {'part': part, 'kind': kind}])}) k"
    return f"SELECT doc_id, pos, line, {part} AS part, {kind} AS kind FROM (SELECT doc_id, pos, line, {option} AS option FROM ({source}) l) o"


def questions(d: Dialect, source: str) -> str:
    """doc_id, pos, line, last_pos, n_parts: lines with their options, `Allergic to?`, `(check all)`, `[ ] Latex`, `- Sulfa` as
    `Allergic to? [ ] Latex [ ] Sulfa` and `(check all)`.

    One pass with the open question as its state. A prompt opens one; lines of options join it, over up to REACH blank or
    guiding lines since the last of it, which stay lines of their own; any other line closes it. Options without a prompt
    open a question themselves, which only options right below join. No line is lost.
    """
    open_ = f"s.at <> {NOWHERE}"
    joins = f"(x.kind = 'option' AND {open_} AND s.gap <= CASE WHEN s.prompted THEN {REACH} ELSE 0 END)"
    passes = f"(x.kind IN ('blank', 'guidance') AND s.gap < {REACH + 1})"
    opens = f"(x.kind = 'prompt' OR (x.kind = 'option' AND NOT {joins}))"
    keeps = f"({joins} OR {passes})"
    state = {
        "at": ("bigint", NOWHERE, f"CASE WHEN {keeps} THEN s.at WHEN {opens} THEN x.pos ELSE {NOWHERE} END"),
        "upto": ("bigint", NOWHERE, f"CASE WHEN {passes} THEN s.upto WHEN {joins} OR {opens} THEN x.pos ELSE {NOWHERE} END"),
        "text": ("string", "''", f"CASE WHEN {joins} THEN concat(s.text, ' ', x.part) WHEN {passes} THEN s.text WHEN {opens} THEN x.part ELSE '' END"),
        "parts": ("int", "0", f"CASE WHEN {joins} THEN s.parts + 1 WHEN {passes} THEN s.parts WHEN {opens} THEN 1 ELSE 0 END"),
        "prompted": ("boolean", "false", f"CASE WHEN {keeps} THEN s.prompted ELSE x.kind = 'prompt' END"),
        "gap": ("int", "0", f"CASE WHEN {passes} THEN s.gap + 1 ELSE 0 END"),
    }
    done = {"pos": "s.at", "line": "s.text", "last_pos": "s.upto", "n_parts": "s.parts"}
    itself = {"pos": "x.pos", "line": "x.line", "last_pos": "x.pos", "n_parts": "1"}
    emits = [(f"{open_} AND NOT {keeps}", done), (f"x.kind IN ('blank', 'guidance', 'other') AND x.pos < {AFTER}", itself)]
    end = {"pos": AFTER, "line": "''", "part": "''", "kind": "'other'"}
    columns = {"pos": "bigint", "line": "string", "part": "string", "kind": "string"}
    return d.fold(line_kinds(d, source), ["pos"], columns, state, {"pos": "bigint", "line": "string", "last_pos": "bigint", "n_parts": "int"}, emits, end)


# How a field's title or line begins that depends on the answer before, by the answer.
CONDITIONS = ((r"^if +(no|not|none)\b", "no"), (r"^if +(yes|so|applicable|checked)\b|^(please +)?(explain|describe|specify)\b|^please +list\b", "yes"))


def condition(d: Dialect, title: str) -> str:
    """The answer that a title depends on; empty if it depends on none."""
    return d.case([(d.has(d.trim(title), p, ci=True), d.lit(answer)) for p, answer in CONDITIONS], "''")


def asks_yes_no(d: Dialect, options: str) -> str:
    return d.has(options, r"(^|[|]) *yes *([|]|$)", ci=True)


WIDTH = 8


def nested(d: Dialect, source: str, order: tuple[str, ...] = ("pos", "sub"), carry: dict[str, str] | None = None) -> str:
    """doc_id, place, parent, depth, path, answer for each field (with `place`, unique in its document): under which question
    it stands, and on which of its answers it depends. carry: further columns, with types.

    One pass with the open yes-or-no questions as its state, the innermost last. A field whose title is conditional stands
    under the innermost; if it can be answered yes itself it is the next one to be; any other field closes them all. The path
    is that of the places from the outermost question, so its order is that of the tree, parents first.
    """
    seg = lambda x: f"lpad(cast({x} as string), {WIDTH}, '0')"
    under = "(x.answer <> '' AND s.path <> '')"
    parent = f"CASE WHEN {under} THEN cast(right(s.path, {WIDTH}) as bigint) END"
    path = f"concat(CASE WHEN {under} THEN concat(s.path, '.') ELSE '' END, {seg('x.place')})"
    state = {"path": ("string", "''", f"CASE WHEN x.asks THEN {path} WHEN {under} THEN s.path ELSE '' END")}
    out = {"place": "bigint", "parent": "bigint", "depth": "int", "path": "string", "answer": "string"}
    row = {"place": "x.place", "parent": parent, "depth": f"CASE WHEN {under} THEN cast((length(s.path) + 1) as int) {'div' if d.spark else '//'} {WIDTH + 1} ELSE 0 END", "path": path, "answer": f"CASE WHEN {under} THEN x.answer ELSE '' END"}
    seen = f"SELECT *, {condition(d, 'title')} AS answer, {asks_yes_no(d, 'options')} AS asks FROM ({source}) n"
    if d.spark:
        seen = K.ruled(d, source, ["title", "options"], {"answer": condition(d, "title"), "asks": asks_yes_no(d, "options")})
    carry = carry or {}
    out |= carry
    row |= {c: f"x.{c}" for c in carry}
    end = {"place": NOWHERE, "answer": "''", "asks": "false"} | dict.fromkeys(carry, "NULL")
    return d.fold(seen, list(order), {"place": "bigint", "answer": "string", "asks": "boolean"} | carry, state, out, [(f"x.place <> {NOWHERE}", row)], end)


def tree_keys(d: Dialect, source: str, columns: str = "") -> str:
    """doc_id, place, key (and further columns): keys of a tree of fields (doc_id, place, key, type, path) made unique in their document.

    The n-th of equal keys, in the order of the paths and so parents before children, ends in _n; a signature's key stays.
    As the made key may be one that is there already (`a`, `a`, `a_2`), the made keys are numbered once more among those
    that they meet.
    """
    number = lambda key, source, first, kind="type": f"""SELECT *, CASE WHEN n > 1 AND NOT ({kind} = 'signature') THEN concat({key}, '_', cast(n as varchar(10))) ELSE {key} END AS numbered FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, {key} ORDER BY {first}path, place) AS n FROM ({source}) k) r"""  # noqa: E731
    more = f", {columns}" if columns else ""
    once = f"SELECT doc_id, place, path, type AS kind_, numbered AS made{more}, CASE WHEN numbered = key THEN 0 ELSE 1 END AS new FROM ({number('key', source, '')}) a"
    return f"SELECT doc_id, place, numbered AS key{more} FROM ({number('made', once, 'new, ', 'kind_')}) b"


# What the lines of a signature block hold.
SIGNS, NAMES, DATES, WITNESSES, GUARDIANS = r"\bsignature\b|\bsigned\b|\bsign +here\b", r"\b(print(ed)?|full|patient('s)?|legal) +name\b|\bname +\(?print", r"\bdate\b", r"\bwitness\b", r"\b(guardian|parent|responsible +party)\b"


def signature_blocks(d: Dialect, source: str, within: int = 3) -> str:
    """doc_id, pos, last_pos, n_lines, has_name, has_witness, variant: blocks of lines with a signature and a date, in any
    order, each at most `within` lines after the one before it that has a part of a block.

    One pass with the open block's parts as its state. A line of over 12 words is prose, which has no part. A block without
    a signature or a date isn't one: `Date of Birth: ____` alone, or a signature alone.
    """
    prose = f"{d.words('line')} > 12"
    part = lambda p, but="false": f"CASE WHEN NOT ({prose}) AND {d.has('line', p, ci=True)} AND NOT ({but}) THEN 1 ELSE 0 END"
    seen = f"""SELECT doc_id, pos, {part(SIGNS)} AS sign, {part(NAMES)} AS name, {part(DATES, d.has('line', r'date +of +birth|birth *date', ci=True))} AS dated, {part(WITNESSES)} AS witness,
  {part(GUARDIANS)} AS guardian FROM ({source}) l"""
    parts = ("sign", "name", "dated", "witness", "guardian")
    any_ = "(x.sign + x.name + x.dated + x.witness > 0)"
    near = f"(s.at <> {NOWHERE} AND x.pos - s.upto <= {within})"
    state = {
        "at": ("bigint", NOWHERE, f"CASE WHEN {near} THEN s.at WHEN {any_} THEN x.pos ELSE {NOWHERE} END"), "upto": ("bigint", NOWHERE, f"CASE WHEN {any_} THEN x.pos WHEN {near} THEN s.upto ELSE {NOWHERE} END"),
        **{p: ("int", "0", f"CASE WHEN {near} THEN greatest(s.{p}, x.{p}) WHEN {any_} THEN x.{p} ELSE 0 END") for p in parts},
    }
    row = {"pos": "s.at", "last_pos": "s.upto", "n_lines": "s.upto - s.at + 1", "has_name": "s.name = 1", "has_witness": "s.witness = 1", "variant": "CASE WHEN s.guardian = 1 THEN 'adult_with_guardian_details' ELSE 'adult_no_guardian_details' END"}
    out = {"pos": "bigint", "last_pos": "bigint", "n_lines": "bigint", "has_name": "boolean", "has_witness": "boolean", "variant": "string"}
    columns = {"pos": "bigint"} | dict.fromkeys(parts, "int")
    end = {"pos": AFTER} | dict.fromkeys(parts, "0")
    return d.fold(seen, ["pos"], columns, state, out, [(f"s.at <> {NOWHERE} AND NOT {near} AND s.sign = 1 AND s.dated = 1", row)], end)
