"""Dictionaries of templates: checks of their fields as violation rows, and their expansion by templates and aliases."""

from __future__ import annotations

import json

from ..functions import text as T
from ..functions.dialect import Dialect
from . import validate

#: Types that a dictionary may name, and input types of a control.
TYPES = ("input", "radio", "checkbox", "dropdown", "date", "states", "block_signature", "block_text", "photo", "text", "multiradio", "terms")
INPUT_TYPES = ("text", "email", "phone", "ssn", "name", "date", "past", "future", "zip")
#: Aliases (phrase, key) that an expansion adds where they are missing.
NEW_ALIASES = (
    ("are_you_under_a_physicians_care_now", "1.under_care"), ("are_you_under_physician_care", "1.under_care"), ("under_doctors_care", "1.under_care"), ("have_you_ever_been_hospitalized", "hospitalized"), ("have_you_had_surgery", "hospitalized"),
    ("have_you_ever_had_major_surgery", "hospitalized"), ("are_you_taking_any_medications", "taking_medication"), ("taking_any_medicine", "taking_medication"), ("current_medications", "taking_medication"), ("do_you_have_allergies", "allergies"),
    ("allergic_to_any_medications", "allergies"), ("medical_conditions", "medical_conditions"), ("medical_history", "medical_conditions"), ("health_conditions", "medical_conditions"),
)


# Options of the template that an expansion adds.
MEDICAL_CONDITIONS = (
    "Heart Disease", "High Blood Pressure", "Low Blood Pressure", "Stroke", "Heart Attack", "Angina", "Heart Murmur", "Rheumatic Fever", "Artificial Heart Valve", "Pacemaker", "Diabetes", "Hypoglycemia", "Thyroid Disease",
    "Cancer", "Chemotherapy", "Radiation Therapy", "Anemia", "Blood Disorder", "Bleeding Disorder", "Hepatitis", "Liver Disease", "Kidney Disease", "Asthma", "Emphysema", "Tuberculosis", "COPD", "Arthritis", "Rheumatism",
    "Joint Replacement", "Osteoporosis", "Bone Disease", "HIV/AIDS", "Sexually Transmitted Disease", "Seizures", "Epilepsy", "Neurological Disorder", "Mental Health Disorder", "Depression", "Anxiety", "Glaucoma",
    "Vision Problems", "Stomach/Intestinal Disease", "Ulcers", "Pregnancy", "Nursing",
)


def conditions_template() -> str:
    """The category that an expansion adds, as JSON."""
    options = [{"name": c, "value": c.lower().replace(" ", "_").replace("/", "_")} for c in MEDICAL_CONDITIONS]
    return json.dumps([{"key": "medical_conditions", "type": "conditions", "title": "Do you have or have you had any of the following?", "section": "Medical History", "optional": False, "control": {"options": options}}])


def from_parts(d: Dialect) -> str:
    """A dictionary's fields (category, idx, key, type, input_type, options, if_key, version) derived from the parts, good and bad ones."""
    kinds = ("input", "radio", "dropdown", "date", "checkbox", "slider")
    kind = d.case([(f"p_size % 7 = {i}", d.lit(k)) for i, k in enumerate(kinds)], "NULL")
    return f"""SELECT p_brand AS category, p_partkey AS idx, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat({T.slugify(d, "p_name")}, '_', cast(p_partkey as varchar(20))) END AS key, {kind} AS type,
  CASE WHEN p_size % 4 = 0 THEN 'text' WHEN p_size % 4 = 1 THEN 'colour' END AS input_type, CASE WHEN p_size % 3 = 0 THEN 'Yes|No' WHEN p_size % 3 = 1 THEN 'Yes|' ELSE '' END AS options, CASE WHEN p_size % 6 IN (0, 1) THEN 'true|false' WHEN p_size % 3 IN (0, 1) THEN 'true|' ELSE '' END AS option_values,
  CASE WHEN p_partkey % 5 = 0 THEN concat({T.slugify(d, "p_name")}, '_', cast(p_partkey - p_partkey % 2 as varchar(20))) END AS if_key, CASE WHEN p_size > 25 THEN '1.2.0' ELSE '1.2' END AS version FROM part"""


def violations(d: Dialect, source: str) -> str:
    """category, idx, key, rule, severity: fields without key or type, unusual types, bad controls and options, versions that
    aren't three numbers, and conditions on keys that no field has. The source is read once: each field is a row as the owner of its key and one as the
    asker of its condition's, and those of one key meet in a window."""
    names = d.split("options", r"\|")
    rules = [
        ("key_missing", "error", "key IS NULL"), ("type_missing", "error", "key IS NOT NULL AND type IS NULL"), ("type_unusual", "warning", f"key IS NOT NULL AND type NOT IN ({', '.join(map(d.lit, TYPES))})"),
        ("input_type_unusual", "warning", f"key IS NOT NULL AND input_type NOT IN ({', '.join(map(d.lit, INPUT_TYPES))})"), ("option_name_missing", "error", f"key IS NOT NULL AND type IN ('radio', 'checkbox', 'dropdown') AND options <> '' AND {d.size(d.filter(names, 'o', chr(111) + ' = ' + d.lit('')))} > 0"),
        ("option_value_missing", "warning", f"key IS NOT NULL AND type IN ('radio', 'checkbox', 'dropdown') AND options <> '' AND {d.size(d.filter(d.split('option_values', '[|]'), 'o', chr(111) + ' = ' + d.lit('')))} > 0"),
        ("version_form", "warning", f"NOT {d.has('version', '^[0-9]+[.][0-9]+[.][0-9]+$')}"), ("if_unknown", "warning", "key IS NOT NULL AND if_key IS NOT NULL AND known IS NULL"),
    ]
    both = "array(key, if_key)" if d.spark else "[key, if_key]"
    roles = d.exploded(f"({source}) s", both, "category, idx, key, type, input_type, options, option_values, if_key, version", "named", pos="part")
    checked = f"SELECT * FROM (SELECT *, max(CASE WHEN part = 0 AND named IS NOT NULL THEN 1 END) OVER (PARTITION BY named) AS known FROM ({roles}) r) k WHERE part = 1"
    return validate.as_rows(d, checked, rules, "category, idx")


def structure(d: Dialect, source: str) -> str:
    """Each category with its fields, keys and keys that occur twice."""
    return f"SELECT category, count(*) AS n_fields, count(key) AS n_keys, count(key) - count(DISTINCT key) AS n_repeated FROM ({source}) s GROUP BY category"


def expanded_aliases(d: Dialect, have: str) -> str:
    """The aliases (phrase, key) of a dictionary and those of NEW_ALIASES whose phrase it lacks, each with where it is from."""
    new = "SELECT * FROM (VALUES " + ", ".join(f"({d.lit(a)}, {d.lit(k)})" for a, k in NEW_ALIASES) + ") v(phrase, key)"
    return f"SELECT phrase, key, 'kept' AS origin FROM ({have}) h UNION ALL SELECT n.phrase, n.key, 'added' AS origin FROM ({new}) n LEFT JOIN ({have}) h ON n.phrase = h.phrase WHERE h.phrase IS NULL"


def next_version(d: Dialect, version: str) -> str:
    """The next minor version."""
    part = lambda i: d.first(version, r"^([0-9]+)[.]([0-9]+)[.]([0-9]+)$", i)
    return f"CASE WHEN {part(1)} = '' THEN {version} ELSE concat({part(1)}, '.', cast(cast({part(2)} as int) + 1 as varchar(10)), '.0') END"
