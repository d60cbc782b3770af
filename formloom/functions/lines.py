"""Predicates over single lines of a document, and the classes they make."""

from __future__ import annotations

from . import text as T
from .dialect import Dialect

BOX = r"\[ *\]|\[x\]|☐|☑|□|■|❒|◻|✓|✔|✗|✘"

# Phrases and patterns of each predicate.
STRONG_HEADINGS = (
    "patient information", "medical history", "dental history", "insurance information", "consent", "signature", "emergency contact", "responsible party", "health history", "treatment information",
    "financial information", "dental benefit plan",
)
KNOWN_LABELS = r"\b(first|last|middle|full|patient) *name\b|\b(home|work|cell|mobile) *phone\b|\bdate of birth\b|\bdob\b|\bssn\b|\bzip( *code)?\b|\be-?mail\b|\bmarital status\b|\bemployer\b|\boccupation\b"
FIELD_WORDS = (r"\b(ext|extension|apt|apartment|ssn|dob|zip|zipcode|state) *#?\b", r"\b(phone|email|fax|mobile|cell|home|work)\b", r"\b(first|last|middle|full) +name\b")
CATEGORY_WORDS = (
    "cancer", "cardiovascular", "endocrinology", "musculoskeletal", "respiratory", "gastrointestinal", "neurological", "hematologic", "appearance", "function", "habits", "social", "periodontal", "pain",
    "discomfort", "comfort", "allergies", "women", "type", "viral infections", "medical allergies", "sleep pattern",
)
INSTRUCTION_STARTS = (
    r"^i +(hereby +)?(understand|certify|acknowledge|consent|agree|authorize|give)", r"^(the +)?patient +(understands?|acknowledges?|consents?|agrees?)", r"^by +signing", r"^i +have +(read|been +(informed|given))",
    r"^(this|it) +is +(understood|acknowledged)", r"^we +(understand|acknowledge)", r"^do +not +(consume|take|eat|drink|smoke)", r"^please +(arrive|bring|remove|wear|leave)", r"^ensure +(you|that)", r"^your +escort +must",
    r"^we +reserve +the +right", r"^if +you +do +not", r"^(take|wear|remove|bring|arrive) +(any|your|all|the|short)",
    r"^this +(consent +)?form +(should|must|is|will)", r"^this +(document|consent) +(should|must|is|will)",
)
RISK_TERMS = ("may include", "may result in", "possible risks", "complications", "not limited to", "include but", "such as", "alternative treatment", "necessitating", "have been explained")
EXPLAINING = ("this means that", "it is important to", "you should", "please note", "be aware that", "keep in mind", "it is your responsibility")
METADATA = (
    r"(^|[^\p{L}\p{N}])rev *[a-z0-9]($|[^\p{L}\p{N}])", r"[a-z][0-9]{4,6}_rev_[a-z0-9]", r"\bv[0-9]+\.[0-9]+\b", r"\bversion +[0-9]+", r"all +rights +reserved", r"©|copyright +[0-9]{4}", r"^ *\([0-9]{3}\) *[0-9]{3}-[0-9]{4} *$",
    r"www\.[a-z0-9_]+\.com", r"^ *[a-z][0-9]{4,6} *$", r"\b(inc|llc|ltd|corp|corporation)\b.*\([0-9]{3}\)",
)
STREET = r"\b[0-9]+ +[NSEW]?\.? *[A-Za-z]+ +(ave|avenue|st|street|rd|road|blvd|boulevard|dr|drive|ln|lane|way|ct|court)\b"
CITY_STATE_ZIP = r", *[A-Z]{2} +[0-9]{5}"
PRACTICE = r"\b(dental|dentistry) +(care|center|design|solutions|office|group|associates)\b|\bdentistry\b|\borthodontics\b|\boral surgery\b"
CONSENT = (
    r"\bi +(hereby +)?(certify|acknowledge|consent|agree|understand|authorize|give +permission)", r"\bpatient +(acknowledges?|consents?|agrees?)", r"\bby +signing", r"\bi +have +(read|been +informed|received)",
    r"\bto +the +best +of +my +knowledge", r"\bi +give +(my +)?consent", r"\bpossible +(risks?|complications?|side +effects)", r"\bmay +(include|result +in|cause)", r"\btreatment +(may|can|could)",
)
CONSENT_HEADINGS = ("informed consent", "patient consent", "consent for treatment", "acknowledgment", "risks and complications", "possible risks", "potential complications", "patient responsibilities", "financial responsibility", "payment policy", "notice of privacy", "hipaa", "authorization", "release of information")
RISK_HEADINGS = ("risks and complications", "possible risks", "potential complications", "these potential risks", "complications include", "risks include", "may include", "following risks", "following complications")
RISK_WORDS = ("pain", "infection", "swelling", "bleeding", "damage", "injury", "numbness", "tingling", "bruising", "discomfort", "sensitivity", "failure", "fracture", "breakage", "allergic", "reaction")
PROCEDURE = (
    r"\b(procedure|treatment|therapy|surgery|operation) +(involves|includes|consists +of|is|may)", r"\bthe +(procedure|treatment|therapy) +(will|may|can|should)", r"\b(risks?|complications?) +(include|may +include|are|can +be)",
    r"\b(possible|potential) +(risks?|complications?|side +effects)", r"\bmay +(result +in|cause|lead +to|experience)", r"\b(success +rate|no +guarantee|cannot +guarantee|alternatives? +(include|are))",
    r"\b(may|might) +(not|fail|be +unsuccessful)", r"\b(tooth|teeth|gum|tissue|bone|nerve|jaw|sinus) +(may|will|can) +(be|need)",
)
MEDICAL_TERMS = ("anesthesia", "anesthetic", "sedation", "extraction", "implant", "periodontal", "endodontic", "prosthetic", "restoration", "surgical", "incision", "sutures", "healing", "infection", "swelling", "bleeding")


def has_box(d: Dialect, x: str) -> str:
    return d.has(x, BOX)


def is_heading(d: Dialect, x: str) -> str:
    """A section's heading, by rules in order: no box, one colon at most, a known start, capitals, no known label ..."""
    t, low = "t", "low"
    upper = f"({t} = upper({t}) AND {d.has(t, '[A-Z]')})"
    multi = f"length({t}) <= 120 AND {d.words(t)} >= 2 AND {d.has(t, '^[A-Z]')} AND NOT {d.ends(t, '.')}"
    rules = d.case(
        [
            (f"{t} = ''", "false"), (has_box(d, t), "false"), (f"{d.count(t, ':')} >= 2", "false"),
            (" OR ".join(d.starts(low, h) for h in STRONG_HEADINGS), "true"), (f"{upper} AND {d.words(t)} BETWEEN 3 AND 5", "true"),
            (d.has(t, KNOWN_LABELS, ci=True), "false"), (f"{d.contains(t, '?')} OR {d.has(t, '_{3,}|-{3,}|[(] *[)]')}", "false"),
            (d.has(low, "^(comments|notes|explanation|details|remarks)$"), "false"), (multi, "true"), (f"length({t}) <= 120 AND {upper}", "true"),
        ], "false",
    )
    return d.let(d.squeeze(x), "t", d.let(d.sub("lower(t)", r":+$", ""), "low", rules))


def is_heading_in_place(d: Dialect, x: str, following: str, pos: str) -> str:
    """A heading by itself, or by what stands around it: an underlined next line, a centred short line, or an early one in
    title case. Lines with a box, a blank or a question never are."""
    underlined = f"coalesce({d.has(following, r'^ *[-=_]{3,} *$')}, false)"
    return f"({is_heading(d, x)} OR {is_heading_beside(d, x, underlined, f'{pos} < 3')})"


def is_heading_beside(d: Dialect, x: str, underlined: str, at_start: str = "false") -> str:
    """A heading by what stands around it only, or by where it stands."""
    bare = f"length(t) BETWEEN 3 AND 60 AND NOT {d.contains('t', '?')} AND NOT {d.contains('t', '__')} AND NOT {d.contains('t', ':')} AND NOT {d.ends('t', '.')} AND {d.has('t', '^[A-Z]')} AND NOT {has_box(d, 't')}"
    known = d.has("t", KNOWN_LABELS, ci=True)
    centred = f"({d.has(x, '^ {8,}[A-Z]')} AND {d.words('t')} BETWEEN 2 AND 8 AND NOT {known})"
    early = f"({at_start} AND {d.has('t', '^[A-Z][a-z]+( [A-Z][a-z]+)+$')} AND NOT {known})"
    return d.let(d.squeeze(x), 't', f'({bare} AND ({underlined} OR {centred} OR {early}))')


def is_underline(d: Dialect, x: str) -> str:
    """A line that only underlines the one before."""
    return d.has(x, r"^ *[-=]{3,} *$")


def is_category_header(d: Dialect, x: str, following: str) -> str:
    """A short line above a line of boxes, which isn't a field's label."""
    t = d.squeeze(x)
    low = f"lower({t})"
    known = d.any_of(low, CATEGORY_WORDS)
    return d.case(
        [
            (f"{t} = '' OR length({t}) > 80", "false"), (f"{has_box(d, t)} OR {d.ends(t, '?')} OR {d.ends(t, ':')} OR {d.has(t, ': *[^ ]')}", "false"), (f"{d.any_match(t, FIELD_WORDS, ci=True)}", "false"),
            (f"coalesce({has_box(d, following)}, false) AND ({d.words(t)} <= 6 OR {known})", "true"), (f"{known} AND {d.words(t)} <= 3", "true"),
        ], "false",
    )


def is_numbered_item(d: Dialect, x: str) -> str:
    return d.has(d.trim(x), r"^\(([ivxlcdmIVXLCDM]+|[0-9]{1,2})\) *[A-Za-z]|^[ivxlcdm]+\) +[A-Za-z]|^[0-9]{1,2}\. +[A-Z]")


def is_instruction(d: Dialect, x: str) -> str:
    """A paragraph to read rather than a field to fill."""
    t = d.trim(x)
    low = f"lower({t})"
    sentences = f"{d.count(t, '[.]')} - {d.count(t, r'\b(Dr|Mr|Mrs|Ms|Inc|Ltd|Jr|Sr|etc)[.]', ci=True)}"
    return d.case(
        [
            (f"length({t}) < 30", "false"), (f"{d.count(t, '_{3,}')} >= 3 OR {d.count(t, ':')} >= 5", "false"), (d.has(t, r"_{3,} *\([^)]{3,40}\)"), "false"),
            (f"{d.words(t)} > 50 OR length({t}) > 250", "true"), (f"{sentences} >= 2", "true"), (f"{d.any_match(low, INSTRUCTION_STARTS)} AND {d.words(t)} > 6", "true"),
            (f"{d.words(t)} > 20 AND {d.any_of(low, RISK_TERMS)}", "true"), (f"{d.words(t)} > 25 AND {d.any_of(low, EXPLAINING)}", "true"),
        ], "false",
    )


def is_metadata(d: Dialect, x: str) -> str:
    """Form codes, revisions and notices. A lone token is one only if digits and letters or underscores mix in it."""
    low = f"lower({d.trim(x)})"
    code = f"length({low}) BETWEEN 3 AND 12 AND {d.has(low, '^[a-z0-9_-]+$')} AND {d.has(low, '[0-9_]')} AND {d.has(low, '[a-z]')}"
    return f"(length({low}) >= 3 AND ({d.any_match(low, METADATA)} OR ({code})))"


def has_address(d: Dialect, x: str) -> str:
    return f"({d.has(x, STREET, ci=True)} OR {d.has(x, CITY_STATE_ZIP)} OR {d.has(x, '[0-9]{5}(-[0-9]{4})?$')})"


def is_practice_location(d: Dialect, x: str, before: str, before2: str) -> str:
    """A practice with an address, an address after an address, or a line that begins with a street number."""
    near = f"(coalesce({has_address(d, before)}, false) OR coalesce({has_address(d, before2)}, false))"
    return f"(length({x}) >= 10 AND (({d.has(x, PRACTICE, ci=True)} AND {has_address(d, x)}) OR ({near} AND {has_address(d, x)}) OR {d.has(x, r'^ *[0-9]+ +[NSEW][.]? +[A-Za-z]+')}))"


def is_consent_paragraph(d: Dialect, x: str) -> str:
    low = f"lower({d.trim(x)})"
    start = " OR ".join(d.has(low, "^" + p.removeprefix(r"\b")) for p in CONSENT[:6])
    return f"(length({x}) >= 50 AND ({d.matches(low, CONSENT)} >= 2 OR {start}))"


def is_consent_heading(d: Dialect, x: str) -> str:
    low = f"lower({d.trim(x)})"
    short = f"length({x}) < 60 AND NOT {d.contains(x, ':')} AND {d.any_of(low, ('consent', 'risks', 'complications', 'authorization', 'acknowledgment'))}"
    return f"({d.any_of(low, CONSENT_HEADINGS)} OR ({short}))"


def is_terms(d: Dialect, x: str) -> str:
    """Legal text: two indications, or one strong one, or one in a long text. One search tells that there is none at all."""
    low = f"lower({x})"
    return f"({d.any_match(low, CONSENT)} AND ({d.matches(low, CONSENT)} >= 2 OR (length({x}) > 30 AND {d.any_match(low, CONSENT[:3])}) OR (length({x}) > 80 AND {d.any_match(low, CONSENT[3:])})))"


def should_be_terms(d: Dialect, x: str) -> str:
    return f"({is_terms(d, x)} OR length({x}) > 200 OR {d.any_of(f'lower({x})', ('terms', 'consent', 'agreement', 'acknowledgment', 'disclosure'))})"


def is_risk_heading(d: Dialect, x: str) -> str:
    return d.any_of(f"lower({x})", RISK_HEADINGS)


def is_risk_item(d: Dialect, x: str) -> str:
    t = d.trim(x)
    shape = d.has(t, r"^[A-Z][a-z]+ing +|^[A-Z][a-z]+ +(of|to|in|or) +|^[A-Za-z]+ +(may|can|could) +")
    return f"(length({t}) < 150 AND {d.ends(t, '.')} AND ({shape} OR {d.any_of(f'lower({t})', RISK_WORDS)}))"


def is_procedure_text(d: Dialect, x: str) -> str:
    low = f"lower({x})"
    return f"(length({x}) >= 40 AND ({d.matches(low, PROCEDURE)} >= 2 OR (length({x}) > 100 AND {d.hits(low, MEDICAL_TERMS)} >= 3)))"


def is_signature(d: Dialect, x: str) -> str:
    return d.has(f"lower({x})", r"\bsignature\b|\bsigned +by\b|\bsign +here\b")


def is_signature_line(d: Dialect, x: str) -> str:
    return f"({d.has(f'lower({x})', r'signature|sign here|signed')} OR {d.has(f'lower({x})', r'_{3,}.*date.*_{3,}')})"


def is_tabulated_signature(d: Dialect, x: str) -> str:
    return f"({d.count(x, chr(9))} >= 1 AND {d.count(x, r'[^\t]*[^\t ][^\t]*')} >= 2 AND {d.has(f'lower({x})', 'sign|witness')})"


def has_orphan_boxes(d: Dialect, x: str) -> str:
    """Two boxes or more with almost no text of their own."""
    return f"({d.count(x, BOX)} >= 2 AND length({d.trim(d.sub(x, BOX, ''))}) < 6)"


def is_other_specify(d: Dialect, x: str) -> str:
    return d.has(f"lower({d.trim(x)})", r"^other\b|please specify|if other")


def is_valid_key(d: Dialect, x: str) -> str:
    return d.has(x, "^[a-z_][a-z0-9_]*$")


def is_option_dump(d: Dialect, title: str) -> str:
    """A title that holds three condition words or more: a grid that was read as one field."""
    return f"{d.hits(f'lower({title})', ('diabetes', 'arthritis', 'hepatitis', 'asthma', 'stroke', 'ulcer', 'thyroid', 'cancer', 'anemia', 'glaucoma', 'kidney', 'liver', 'anxiety', 'depression'))} >= 3"


def is_junk(d: Dialect, key: str, title: str) -> str:
    return f"({key} = 'q' OR length({d.trim(title)}) <= 1 OR {d.contains(title, '<<<')} OR {is_instruction(d, title)})"


def weak_label(d: Dialect, x: str) -> str:
    """Class of a line by rules, for training: question, option, field_label, value or noise."""
    t, low = "t", "lower(t)"
    half = f"length({d.first(t, '^[^:]*')}) > length({t}) / 2"
    before = d.trim(d.first(t, "^[^_]*"))
    rules = d.case(
        [
            (f"{t} = ''", "'noise'"), (f"{d.contains(t, '?')} AND {d.has(low, '^(are you|do you|have you|is|does|can)')}", "'question'"), (f"{has_box(d, t)} AND length({t}) < 50", "'option'"), (has_box(d, t), "'question'"),
            (f"{d.ends(t, ':')} OR ({d.contains(t, ':')} AND {half})", "'field_label'"), (f"{d.count(x, '_')} >= 5 AND length({before}) BETWEEN 1 AND 29", "'field_label'"), (f"{d.count(x, '_')} >= 5", "'value'"),
            (d.has(low, r"\b(phone|cell|mobile|telephone|email|date|dob|birth)\b"), "'field_label'"), (f"{d.any_of(low, ('name', 'first', 'last', 'middle', 'patient'))} AND ({d.contains(t, ':')} OR {d.contains(t, '_')})", "'field_label'"),
            (f"length({t}) > 100", "'noise'"), (f"length({t}) < 50", "'field_label'"),
        ], "'noise'",
    )
    return d.let(d.trim(x), "t", rules)


def features(d: Dialect, x: str, before: str, after: str, pos: str, total: str) -> dict[str, str]:
    """Numbers that describe a line, its neighbours and its place, for the line classifier."""
    t = d.trim(x)
    flag = lambda c: f"cast(coalesce({c}, false) as int)"
    return {
        "has_colon": flag(d.contains(t, ":")), "has_underscore": flag(d.contains(t, "_")), "has_box": flag(has_box(d, t)), "has_question": flag(d.contains(t, "?")), "has_parentheses": flag(d.has(t, r"\(.*\)")),
        "n_words": d.words(t), "n_chars": f"length({t})", "relative_pos": f"cast(round({pos} * 1.0 / greatest({total}, 1), 6) as double)", "in_first_third": flag(f"{pos} * 3 < {total}"), "in_last_third": flag(f"{pos} * 3 >= 2 * {total}"),
        "leading": f"length({x}) - length({d.sub(x, '^[ ]+', '')})", "underscores": d.count(x, "_"), "before_colon": flag(d.contains(before, ":")), "after_colon": flag(d.contains(after, ":")),
        "before_short": flag(f"length({before}) < 20"), "after_short": flag(f"length({after}) < 20"), "capital_start": flag(d.has(t, "^[A-Z]")), "all_capitals": flag(f"{t} = upper({t}) AND {d.has(t, '[A-Z]')}"),
        "dates": flag(d.has(t, r"\b(date|dob|birth)\b", ci=True)), "phones": flag(d.has(t, r"\b(phone|cell|mobile)\b", ci=True)), "emails": flag(d.has(t, r"\be-?mail\b", ci=True)), "insurance": flag(d.has(t, "insurance", ci=True)),
        "ssn": flag(d.has(t, r"\bssn\b|social security", ci=True)), "zips": flag(d.has(t, r"\b(zip|postal)\b", ci=True)), "ends_colon": flag(d.ends(t, ":")), "commas": d.count(t, ","), "periods": d.count(t, "[.]"),
    }


def section_title(d: Dialect, x: str) -> str:
    return T.section_name(d, x)
