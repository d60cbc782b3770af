"""Fields: types, input types, options, keys in context, sections and confidence."""

from __future__ import annotations

from . import lines as L
from . import text as T
from .dialect import Dialect

# Words of each kind of field.
NAME = r"\b(first|last|full|patient|insured|parent|guardian|subscriber|member|legal|printed|representative)('?s)? *name\b|^name$|^name of (patient|insured|parent|guardian|subscriber)"
KINDS = (
    ("name", NAME), ("ssn", r"\b(ssn|social security|soc(ial)? *sec(urity)?)\b|ss#"), ("email", r"\be-?mail\b"), ("phone", r"\b(phone|cell|mobile|telephone)\b"),
    ("number", r"\b(age|years?|months?|days?|count|quantity|number|amount|total|how +many)\b"), ("zip", r"\b(zip|postal)\b"), ("initials", r"\binitials?\b"),
)
MULTI = (r"do you have.*any of the following", r"have you (ever )?had.*any of the following", r"are you allergic to.*following", r"check all that apply", r"select +(all|any)")
SINGLE = (r"\bgender\b", r"\bsex\b", r"marital status", r"\byes */ *no\b", r"\byes +or +no\b")
DATE_KEYS = (
    ("birth|dob", "date_of_birth"), ("signature|signed", "signature_date"), ("today|current", "todays_date"), ("treatment", "treatment_date"), ("appointment", "appointment_date"), ("visit", "visit_date"),
    ("procedure", "procedure_date"), ("consent", "consent_date"),
)
DATE_CONTEXT = (
    ("treatment", "treatment_date"), ("appointment", "appointment_date"), ("last visit", "last_visit_date"), ("next visit", "next_visit_date"), ("visit", "visit_date"), ("procedure", "procedure_date"),
    ("emergency", "emergency_date"), ("referred", "referral_date"), ("signature|signed", "signature_date"), ("consent", "consent_date"),
)
DATE_SECTION = (("signature", "signature_date"), ("patient information", "todays_date"), ("consent", "consent_date"), ("insurance", "insurance_date"), ("emergency", "emergency_date"))
MEANINGS = (
    ("name.*(birth|dob)|birth.*date|^date.*birth", "Date Of Birth"), ("name.*(street|address)", "Street Address"), ("name.*city", "City"), ("name.*state", "State"), ("name.*zip", "Zip Code"),
    ("name.*mobile|^phone.*mobile", "Mobile Phone"), ("name.*cell|^phone.*cell", "Cell Phone"), ("name.*home.*phone|^phone.*home", "Home Phone"), ("name.*work.*phone|^phone.*work", "Work Phone"), ("name.*phone", "Phone Number"),
    ("name.*e?mail", "Email Address"), ("name.*employ", "Employer Name"), ("name.*occupation", "Occupation"), ("name.*first", "First Name"), ("name.*last", "Last Name"), ("name.*middle", "Middle Name"),
    ("name.*(ssn|social)", "Social Security Number"), ("name.*member", "Member Id"), ("name.*policy", "Policy Number"), ("^date.*sign", "Signature Date"),
)
IN_SECTION = (
    ("insurance", (("name", "Insurance Holder"), ("date", "Insurance Date"), ("phone", "Insurance Phone"), ("employer", "Insurance Company"), ("id", "Policy ID"), ("number", "Policy Number"))),
    ("emergency contact", (("name", "Emergency Contact Name"), ("phone", "Emergency Phone"), ("relationship", "Emergency Contact Relationship"))),
    ("dental history", (("date", "Last Visit Date"), ("dentist", "Previous Dentist"))), ("medical history", (("date", "Diagnosis Date"), ("condition", "Medical Condition"))),
)
SECTION_WORDS = {
    "Patient Information": ("patient", "name", "address", "phone", "email", "birth", "dob", "age", "gender", "sex", "marital", "ssn", "social security"),
    "Insurance": ("insurance", "policy", "carrier", "subscriber", "member id", "group", "plan", "coverage", "benefit"),
    "Emergency Contact": ("emergency", "contact", "notify", "relationship"),
    "Medical History": ("medical", "health", "condition", "medication", "allerg", "disease", "illness", "surgery", "hospital"),
    "Dental History": ("dental", "dentist", "teeth", "tooth", "cleaning", "x-ray", "filling", "crown", "root canal"),
    "Consent": ("consent", "signature", "sign", "agree", "acknowledge", "understand", "authorize", "certify"),
}
SECTION_RANK = ("Patient Information", "Insurance", "Emergency Contact", "Dental History", "Medical History", "Medications", "Allergies", "HIPAA", "Financial Policy", "Appointment Policy", "General", "Consent", "Consents", "Signature")


def input_type(d: Dialect, label: str) -> str:
    """One search tells whether any kind is there, as most labels have none."""
    return d.let(f"lower({label})", "low_", d.case([(f"NOT {d.any_match('low_', [p for _, p in KINDS])}", "'text'"), *((d.has("low_", p), d.lit(k)) for k, p in KINDS)], "'text'"))


def date_type(d: Dialect, label: str) -> str:
    low = f"lower({label})"
    return d.case([(d.has(low, "birth|dob|sign|consent"), "'past'"), (d.has(low, "appoint|schedul|next visit"), "'future'")], "'past'")


def is_date(d: Dialect, label: str) -> str:
    return d.has(label, r"\b(date|dob|birth|signed)\b", ci=True)


def field_type(d: Dialect, title: str, options: str) -> str:
    """Type of a field from its title and its number of options."""
    return d.case(
        [
            (L.is_signature(d, title), "'signature'"), (L.should_be_terms(d, title), "'terms'"), (f"{options} = 0 AND {is_date(d, title)}", "'date'"), (f"{options} BETWEEN 1 AND 6", "'radio'"), (f"{options} > 6", "'dropdown'"),
            (d.has(f"lower({title})", r"\b(yes *(or|/) *no|y */ *n)\b|\b(are you|do you|have you|did you|is the|will you)"), "'radio'"), (d.has(f"lower({title})", "select all|check all|choose all|multiple|which of the following"), "'dropdown'"),
        ], "'input'",
    )


def label_control(d: Dialect, label: str) -> str:
    """`type/input_type` of a lone label."""
    low = f"lower({label})"
    return d.case(
        [
            (L.is_signature(d, label), "'block_signature/'"), (is_date(d, label), f"concat('date/', {date_type(d, label)})"), (d.has(low, r"^state\b"), "'states/'"), (d.has(low, r"\b(gender|sex|marital status)\b"), "'radio/'"),
            (d.has(low, r"\baddress\b|\bstreet\b"), "'input/address'"),
        ], f"concat('input/', {input_type(d, label)})",
    )


def is_multi(d: Dialect, title: str, options: str) -> str:
    low = f"lower({title})"
    return d.case([(f"{d.any_match(low, MULTI)}", "true"), (f"{d.any_match(low, SINGLE)}", "false")], f"{options} >= 5")


def radio_or_checkbox(d: Dialect, label: str, options: str, yes_no: str) -> str:
    """The final type of a field with options; signatures, terms and dates are left to the caller."""
    low = f"lower({label})"
    return d.case(
        [
            (d.any_of(low, ("gender", "sex", "marital", "status", "select one", "choose one", "yes/no", "yes or no")), "'radio'"), (f"{options} = 2 AND {yes_no}", "'radio'"),
            (d.any_of(low, ("select all", "check all", "applies", "conditions", "symptoms", "allergies", "medications")), "'checkbox'"), (f"{options} > 2", "'checkbox'"),
        ], "'radio'",
    )


def option_value(d: Dialect, name: str) -> str:
    """Value of an option: true and false for Yes and No, else a key."""
    return d.case([(f"lower({d.trim(name)}) = 'yes'", "'true'"), (f"lower({d.trim(name)}) = 'no'", "'false'")], T.slugify(d, name, 80))


def date_key(d: Dialect, title: str, context: str, section: str) -> str:
    """Key of a date field from its title, else the three lines before, else its section."""
    rules = [(d.has(f"lower({title})", p), d.lit(k)) for p, k in DATE_KEYS]
    rules += [(d.has(f"lower({context})", p), d.lit(k)) for p, k in DATE_CONTEXT]
    rules += [(d.contains(f"lower({section})", p), d.lit(k)) for p, k in DATE_SECTION]
    return d.case(rules, "'date'")


def meaning(d: Dialect, label: str) -> str:
    """What a compound label means, by patterns in order; else the label."""
    return d.case([(d.has(f"lower({d.trim(label)})", p), d.lit(k)) for p, k in MEANINGS], label)


def title_in_section(d: Dialect, label: str, section: str) -> str:
    rules = [(f"{d.contains(f'lower({section})', s)} AND {d.contains(f'lower({label})', w)}", d.lit(t)) for s, m in IN_SECTION for w, t in m]
    return d.case(rules, label)


def filled(d: Dialect, value: str) -> str:
    """Whether a value area is `blank`, offers `options` or is `filled`."""
    t = d.trim(f"coalesce({value}, '')")
    return d.case([(d.has(t, r"^[()_\[\] ]*$"), "'blank'"), (d.has(t, r"\[ *\]|☐|□"), "'options'"), (f"length({t}) > 3 AND {d.has(t, '[^ ]{3,}')}", "'filled'")], "'blank'")


def best_section(d: Dialect, title: str, key: str) -> str:
    """The section with most words in a title or key, the first of equals; null without any."""
    scores = {s: d.hits("words", w) for s, w in SECTION_WORDS.items()}
    best = d.let("greatest(" + ", ".join(scores.values()) + ")", "most", d.case([("most = 0", "NULL"), *((f"{v} = most", d.lit(s)) for s, v in scores.items())], "NULL"))
    return d.let(f"concat(lower({title}), ' ', lower({key}))", "words", best)


# Words by which a field of no section gets one, in order of the sections' precedence.
STRONG_MEDICAL = (
    "physician", "hospitalized", "surgery", "surgical", "operation", "medication", "medicine", "prescription", "allergy", "allergic", "hiv", "aids", "diabetes", "cancer", "heart", "blood pressure", "hepatitis", "asthma",
    "arthritis", "alzheimer", "anemia",
)
MEDICAL = ("doctor", "hospital", "drug", "pills", "illness", "disease", "condition", "diagnosis", "reaction", "symptom", "discomfort", "health", "care now", "taking any", "have you had", "have you ever")
DENTAL = ("tooth", "teeth", "gum", "gums", "dental", "dentist", "orthodontic", "orthodontist", "cleaning", "cavity", "cavities", "crown", "filling", "bite", "jaw", "tmj", "smile")
PATIENT = ("name", "address", "phone", "email", "birth", "dob", "ssn", "social security", "gender", "marital", "employer", "occupation", "contact", "nickname", "preferred name")
INSURANCE = ("insurance", "policy", "coverage", "carrier", "subscriber", "member id", "group number", "plan", "benefits", "primary insurance", "secondary insurance", "insurance company")
EMERGENCY = ("emergency contact", "emergency", "notify", "relationship", "emergency phone", "in case of emergency")
AGREEMENT = ("consent", "acknowledge", "agree", "understand", "authorize", "risks", "complications", "terms", "conditions", "authorization")


def told_section(d: Dialect, title: str, key: str) -> str:
    """The section that a title and key tell by enough of their words; null if they don't."""
    n = lambda words: d.hits("told", words)
    rules = [
        (f"{n(PATIENT)} >= 2", "'Patient Information'"), (f"{n(INSURANCE)} >= 1", "'Insurance'"), (f"{n(EMERGENCY)} >= 1", "'Emergency Contact'"), (f"{n(AGREEMENT)} >= 2 OR ({n(AGREEMENT)} >= 1 AND length({title}) > 100)", "'Consent'"),
        (f"{d.any_of('told', STRONG_MEDICAL)} AND {n(DENTAL)} = 0", "'Medical History'"), (f"{n(MEDICAL)} >= 2 AND {n(MEDICAL)} > {n(DENTAL)}", "'Medical History'"), (f"{n(DENTAL)} >= 2 AND {n(DENTAL)} > {n(MEDICAL)}", "'Dental History'"),
    ]
    return d.let(f"concat(lower({title}), ' ', lower({key}))", "told", d.case(rules, "NULL"))


def home_section(d: Dialect, key: str, title: str, section: str) -> str:
    """Insurance and patient fields back in their sections."""
    both = f"concat(lower({key}), ' ', lower({title}))"
    return d.case([(d.has(both, "insur|subscriber|policy|group_number"), "'Insurance'"), (d.has(both, r"\b(first|last|middle)[_ ]name\b|date_of_birth|\bssn\b"), "'Patient Information'")], section)


def section_rank(d: Dialect, section: str) -> str:
    """Place of a section in the output; Consent and Consents are one."""
    return d.case([(f"{section} = {d.lit(s)}", str(i - (s == "Consents"))) for i, s in enumerate(SECTION_RANK)], "99")


def scoped_key(d: Dialect, key: str, section: str, scope: str) -> str:
    """Insurance keys with the scope, primary or secondary, that is in force."""
    return d.case([(f"{section} = 'Insurance' AND coalesce({scope}, '') <> '' AND NOT {d.contains(key, '__')}", f"concat({key}, '__', {scope})")], key)


def strip_scope(d: Dialect, key: str) -> str:
    return d.sub(key, "__(primary|secondary)$", "")


def guardian_key(d: Dialect, title: str, key: str) -> str:
    low = f"lower({title})"
    who = d.has(low, r"\b(parent|guardian|mother|father)")
    return d.case([(f"{who} AND {d.has(low, 'ssn|social security')}", "'parent_ssn'"), (f"{who} AND {d.contains(low, 'phone')}", "'parent_phone'"), (f"{who} AND {d.contains(low, 'name')}", "'parent_name'")], key)


def signature_type(d: Dialect, title: str, kind: str) -> str:
    """Signatures as blocks; words such as Assigned or Design are no signatures."""
    return d.case([(d.has(f"lower({title})", r"\bsign(ature)?\b|witness"), "'block_signature'")], kind)


def confidence(d: Dialect, key: str, title: str, kind: str, section: str, input_kind: str, match: str = "0.75") -> str:
    """0 to 1: completeness, quality of the title, fit of type and title, and 0.2 times the score of the match, which is 0.75
    where none was tried."""
    given = lambda x: f"cast(coalesce({x}, '') <> '' as int)"
    whole = f"({given(key)} + {given(title)} + {given(kind)} + {given(section)}) / 4.0 * 0.4"
    good = d.case([(f"length({title}) BETWEEN 3 AND 100 AND {d.words(title)} BETWEEN 1 AND 15", "0.2"), (f"length({title}) BETWEEN 3 AND 100", "0.1")], "0.0")
    off = f"({kind} = 'date' AND NOT {d.has(f'lower({title})', 'date|birth|dob|when|day|month|year')}) OR ({kind} = 'input' AND {input_kind} = 'phone' AND NOT {d.has(f'lower({title})', 'phone|cell|mobile|tel|contact')})"
    fit = d.case([(f"coalesce({kind}, '') = ''", "0.0"), (off, "0.1")], "0.2")
    return f"round(cast(least(1.0, {whole} + {good} + {fit} + 0.2 * coalesce({match}, 0)) as double), 6)"


def clean_overflow(d: Dialect, title: str) -> str:
    """A title without a label that ran into it from the next column; short titles, such as "Mobile Phone", stay."""
    return f"CASE WHEN {d.words(title)} >= 5 THEN {d.trim(d.sub(title, r' +(Patient Name|Date of Birth|Date|Signature|Phone|Relationship|Address):?$', ''))} ELSE {title} END"


def is_document_title(d: Dialect, title: str, kind: str) -> str:
    t = d.trim(title)
    return f"({kind} IN ('input', 'checkbox') AND NOT {d.contains(t, ':')} AND NOT {d.contains(t, '?')} AND {d.words(t)} BETWEEN 2 AND 8 AND {d.has(t, r'\b(form|informed consent|registration|questionnaire|agreement|policy)$', ci=True)})"


def excluded(d: Dialect, title: str) -> str:
    """What the output schema doesn't allow: witnesses, headers, footers and practice fields."""
    return d.has(f"lower({title})", r"witness|^page +[0-9]+|office use only|for staff|doctor signature|dentist signature|practice name|all rights reserved")
