"""Rules of the output as violation rows: an empty result is a valid one."""

from __future__ import annotations

from ..functions import lines as L
from ..functions.dialect import Dialect
from . import known as K


#: Types and input types that the output schema knows.
TYPES = ("input", "date", "states", "radio", "dropdown", "checkbox", "terms", "signature", "block_signature")
INPUT_TYPES = ("text", "email", "phone", "ssn", "name", "date", "past", "future", "zip", "number", "initials", "address")


def failing(d: Dialect, rules: list[tuple[str, str, str]]) -> str:
    """Array of `rule|severity` of the rules (name, severity, condition) that a row breaks."""
    items = ", ".join(f"CASE WHEN {c} THEN '{r}|{s}' END" for r, s, c in rules)
    return d.filter(f"array({items})" if d.spark else f"[{items}]", "r", "r IS NOT NULL")


def as_rows(d: Dialect, source: str, rules: list[tuple[str, str, str]], columns: str, key: str = "key") -> str:
    """A row for each rule that a row of `source` breaks. The source is read once, whatever the number of rules."""
    rows = d.exploded(f"(SELECT *, {failing(d, rules)} AS broken FROM ({source}) s) b", "broken", f"{columns}, {key} AS key", "r", pos="rule_no")
    return f"SELECT {columns}, CASE WHEN {d.starts('r', 'one_signature')} THEN '' ELSE key END AS key, {d.first('r', '^[^|]*')} AS rule, {d.first('r', '[^|]*$')} AS severity FROM ({rows}) v"


def violations(d: Dialect, source: str) -> str:
    """doc_id, key, rule, severity for each rule that a field or document breaks; one pass, with windows for the rules that
    look at a whole document."""
    low = "lower(key)"
    told = {"valid": L.is_valid_key(d, "key"), "phone": d.contains(low, "phone"), "dated": d.has(low, "(^|_)date(_|$)"), "insures": d.contains(low, "insurance"), "named": d.contains(low, "name"), "born": d.any_of(low, ("birth", "dob"))}
    if d.spark:  # what a key tells, once for each that is known
        source, told = K.ruled(d, source, ["key"], {f"key_{n}": e for n, e in told.items()}), {n: f"key_{n}" for n in told}
    rules = [
        ("key_format", "error", f"NOT {told['valid']}"), ("key_length", "error", "length(key) > 80"), ("type_known", "error", f"type NOT IN ({', '.join(map(d.lit, TYPES))})"),
        ("phone_type", "warning", f"{told['phone']} AND type = 'input' AND coalesce(input_type, '') <> 'phone'"), ("date_type", "warning", f"{told['dated']} AND type NOT IN ('date', 'input')"),
        ("insurance_section", "warning", f"{told['insures']} AND section <> 'Insurance'"), ("signature_section", "warning", "type = 'block_signature' AND section NOT IN ('Signature', 'Consent', 'Medical History')"), ("title_short", "warning", "length(title) < 3"),
        ("key_unique", "error", "same_key > 1 AND of_key = 1"), ("one_signature", "error", "of_doc = 1 AND signatures <> 1"), ("missing_name", "warning", "of_doc = 1 AND names = 0"), ("missing_dob", "warning", "of_doc = 1 AND births = 0"),
    ]
    per = "OVER (PARTITION BY doc_id)"
    counted = f"""SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS same_key, row_number() OVER (PARTITION BY doc_id, key ORDER BY pos, sub) AS of_key, row_number() OVER (PARTITION BY doc_id ORDER BY pos, sub) AS of_doc,
    sum(CASE WHEN type = 'block_signature' THEN 1 ELSE 0 END) {per} AS signatures, sum(CASE WHEN {told['named']} THEN 1 ELSE 0 END) {per} AS names, sum(CASE WHEN {told['born']} THEN 1 ELSE 0 END) {per} AS births
  FROM ({source}) f"""
    return as_rows(d, counted, rules, "doc_id")


def structure(d: Dialect, records: str) -> str:
    """Output records that lack a required part, have an odd key or type, or a choice without options."""
    rules = [
        *((f"missing_{c}", "error", f"coalesce({c}, '') = ''") for c in ("key", "title", "section", "type")), ("key_format", "warning", f"NOT {d.has('key', '^[a-z0-9_]+$')}"), ("type_known", "error", f"type NOT IN ({', '.join(map(d.lit, TYPES))})"),
        ("control_empty", "warning", "control = '{}' AND type <> 'block_signature'"), ("no_options", "error", f"type IN ('radio', 'dropdown') AND NOT {d.contains('control', chr(34) + 'name' + chr(34))}"),
    ]
    return as_rows(d, records, rules, "doc_id, place, k")


def option_quality(d: Dialect, source: str) -> str:
    """Choices without options, with an option twice, or with one that is no more than marks."""
    names = d.split("options", r"\|")
    rules = [
        ("options_empty", "warning", "options = ''"), ("options_repeated", "warning", f"{d.size(d.distinct(names))} < {d.size(names)}"),
        ("options_malformed", "error", f"options <> '' AND {d.size(d.filter(names, 'o', "NOT " + d.has("o", r"[\p{L}0-9]")))} > 0"),
    ]
    return as_rows(d, f"SELECT * FROM ({source}) f WHERE type IN ('radio', 'dropdown', 'checkbox')", rules, "doc_id, pos, sub")


def summary(d: Dialect, found: str) -> str:
    return f"SELECT rule, severity, count(*) AS n, count(DISTINCT doc_id) AS documents FROM ({found}) v GROUP BY rule, severity"


def general_share(d: Dialect, source: str, most: float = 0.5) -> str:
    """Documents of which more than a share is in no section."""
    return f"SELECT doc_id, cast(round({d.count_if('section = ' + d.lit('General'))} * 1.0 / count(*), 6) as double) AS share FROM ({source}) f GROUP BY doc_id HAVING {d.count_if('section = ' + d.lit('General'))} * 1.0 / count(*) > {most}"


def orphans(d: Dialect, child: str, child_key: str, parent: str, parent_key: str) -> str:
    """References without a target, by an anti join."""
    return f"SELECT c.{child_key} AS missing, count(*) AS n FROM {child} c LEFT JOIN {parent} p ON c.{child_key} = p.{parent_key} WHERE p.{parent_key} IS NULL GROUP BY c.{child_key}"
