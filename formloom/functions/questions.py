"""Known questions and the shapes of compound lines: what to cut from a line, and what it asks."""

from __future__ import annotations

from . import lines as L
from . import text as T
from .dialect import Dialect

# Patterns and words of each known question, one pattern each.
SEX_GENDER = (
    r"\b(sex|gender)\s*[:-]?\s*(M\s*or\s*F|M/F|Male/Female)", r"\b(sex|gender)\s*\[\s*\]\s*(male|female|M|F)", r"\bsex\s*(\[\s*\]|\[x\]|☐|□)\s*male\s*(\[\s*\]|\[x\]|☐|□)\s*female",
    r"\bgender\s*(\[\s*\]|\[x\]|☐|□)\s*male\s*(\[\s*\]|\[x\]|☐|□)\s*female",
)
MARITAL_STATUS = (r"(please\s+)?circle\s+one\s*:?\s*(single|married|divorced|separated|widowed)", r"\bmarital\s+status\s*:?\s*(\[\s*\]|single|married)", r"\bmarital\s+status\s*(\[\s*\]|\[x\]|☐|□)")
PREFERRED_CONTACT = (r"(what\s+is\s+your\s+)?preferred\s+method\s+of\s+contact", r"preferred\s+contact\s+method")
HEAR_ABOUT = r"how\s+did\s+you\s+hear\s+about\s+us"
CONDITION_TOKENS = (
    "diabetes", "arthritis", "rheumat", "hepatitis", "asthma", "stroke", "ulcer", "thyroid", "cancer", "anemia", "glaucoma", "osteoporosis", "seizure", "tb", "tuberculosis", "hiv", "aids", "blood", "pressure", "heart",
    "kidney", "liver", "bleeding", "sinus", "smoke", "chew", "alcohol", "drug", "allergy", "pregnan", "anxiety", "depression", "pacemaker", "cholesterol", "radiation", "chemotherapy", "convulsion", "epilepsy", "migraine",
    "valve", "neurological", "alzheimer",
)
# Tokens that tell a control whose options are conditions.
CONTROL_TOKENS = (
    "diabetes", "arthritis", "rheumat", "hepatitis", "asthma", "stroke", "ulcer", "thyroid", "cancer", "anemia", "glaucoma", "osteoporosis", "seizure", "tb", "tuberculosis", "hiv", "aids", "blood", "pressure", "heart",
    "kidney", "liver", "bleeding", "sinus", "smoke", "chew", "alcohol", "drug", "allergy", "pregnan", "anxiety", "depression", "pacemaker", "irregular", "rregular",
)
FIELD_KEYWORDS = "apt|apartment|unit|suite|city|state|zip|zipcode|postal|country|address|street|ext|extension"
WHOLE_LABELS = (
    "first name", "last name", "middle initial", "middle name", "birth date", "date of birth", "phone number", "email address", "social security", "zip code", "postal code", "area code", "insurance company", "policy holder",
    "member id", "group number", "emergency contact", "marital status",
)
ID_WORDS = r"\b(id|member id|policy id|identification number|subscriber id|policy number|member number)\b"
SSN_WORDS = r"\b(ssn|social security|soc sec)\b"
SIGNATURE_LABELS = r"\b(signature|name|date|witness|provider|patient|guardian|parent|print)\b"
CONDITION_QUESTIONS = (
    r"do +you +have.*(or +have +you +had).*(any +of +the +following|conditions)", r"medical +(history|conditions)", r"health +(history|conditions)", r"have +you +(ever +)?had +any +of +the +following",
)


def none(d: Dialect) -> str:
    return "cast(array() as array<string>)" if d.spark else "[]::VARCHAR[]"


def only(d: Dialect, x: str) -> str:
    return f"array({x})" if d.spark else f"[{x}]"


def from_match(d: Dialect, x: str, patterns: tuple[str, ...]) -> str:
    """What stands from the first match of the first pattern that fits to the end; empty without one."""
    return d.case([(d.has(x, p, ci=True), d.first(x, f"({p}).*$", 0, ci=True)) for p in patterns], "''")


def sex_gender(d: Dialect, x: str) -> str:
    """The segment of a line that asks for sex or gender: with boxes up to the next field, else up to the choice."""
    upto = lambda tail: d.trim(d.case([(d.has(x, p, ci=True), d.first(x, f"^.*?({p}){tail}", 0, ci=True)) for p in SEX_GENDER], "''"))
    boxed = d.has(d.case([(d.has(x, p, ci=True), d.first(x, f"({p}).*$", 0, ci=True)) for p in SEX_GENDER], "''"), L.BOX)
    whole = d.sub(d.sub(upto(".*$"), r" {4,}[A-Z].*$", ""), r"\bmarital +status.*$", "", ci=True)
    return f"CASE WHEN {boxed} THEN {d.trim(whole)} ELSE {upto('')} END"


def sex_segment(d: Dialect, x: str) -> str:
    """The question of sex or gender alone, without what stands before it: its choice, or its boxes up to the next field."""
    at = from_match(d, x, SEX_GENDER)
    choice = d.case([(d.has(x, p, ci=True), d.first(x, p, 0, ci=True)) for p in SEX_GENDER], "''")
    boxed = d.sub(d.sub("at_", r" {4,}[A-Z].*$", ""), r"\bmarital +status.*$", "", ci=True)
    return d.let(at, "at_", f"CASE WHEN {d.has('at_', L.BOX)} THEN {d.trim(boxed)} ELSE {d.trim(choice)} END")


def marital_status(d: Dialect, x: str) -> str:
    return d.trim(from_match(d, x, MARITAL_STATUS))


def preferred_contact(d: Dialect, x: str) -> str:
    """The segment, if it has two boxes or more."""
    found = from_match(d, x, PREFERRED_CONTACT)
    return f"CASE WHEN {d.count(found, L.BOX)} >= 2 THEN {d.trim(found)} ELSE '' END"


def should_split(d: Dialect, x: str) -> str:
    """Whether a line holds several fields; a line of options never does."""
    boxes = d.has(x, r"\[ *\]|[!☐☑☒]|_\]|L_\]")
    many = f"{d.count(x, r'\b(Male|Female|Married|Single|Yes|No|Other)\b', ci=True)} >= 2"
    colons = f"{d.count(x, ':')} >= 5 OR ({d.count(x, ':')} >= 2 AND NOT {d.has(x, '^(I|You|We|The) ')})"
    return f"(NOT ({boxes} AND {many}) AND ({colons} OR {d.has(x, r'[A-Z][a-z]+ *[_ ]{3,}[A-Z][a-z]+ *[_ ]{3,}')}))"


def compound_fields(d: Dialect, x: str) -> str:
    """`A: __ B: __` as `A: __`, `B: __`, each with its own blank or text; other lines stay whole."""
    y = T.separate_blanks(d, x)
    parts = d.filter(d.map(d.split(d.sub(y, r"([A-Z][A-Za-z ]{1,30}):", "\x01$1:"), "\x01"), "p", d.trim("p")), "p", d.has("p", "^[A-Z][A-Za-z ]{1,30}:"))
    filled = d.map(parts, "p", f"CASE WHEN {d.ends('p', ':')} THEN concat(p, ' ___') ELSE p END")
    return f"CASE WHEN {d.count(x, ':')} >= 2 AND length({x}) >= 30 AND NOT {d.contains(x, '?')} AND {d.size(parts)} >= 2 THEN {filled} ELSE {only(d, x)} END"


def boxed_parts(d: Dialect, x: str) -> str:
    """`Sex [ ] M [ ] F     Marital Status [ ] ...` cut at gaps of four blanks before a label with boxes."""
    parts = d.filter(d.map(d.split(d.sub(x, r" {4,}([A-Z][A-Za-z ]{2,30}\[)", "\x01$1"), "\x01"), "p", d.trim("p")), "p", L.has_box(d, "p"))
    return f"CASE WHEN {d.size(parts)} >= 2 THEN {parts} ELSE {only(d, x)} END"


def conditional_parts(d: Dialect, x: str) -> str:
    """`Question? If condition: A    B` as the question and the fields; a follow-up of a yes-or-no question stays with it."""
    before, cond, after = (d.trim(d.first(x, r"^(.*?)\b(if +[^:]{5,40}:)(.*)$", i, ci=True)) for i in (1, 2, 3))
    follow = f"{d.has(before, r'(yes|no|y|n)( *\[| *or )', ci=True)} AND {d.has(cond, 'if yes|if no', ci=True)} AND {d.has(cond, 'explain|specify|list|describe|comment', ci=True)}"
    fields = d.filter(d.map(d.split(after, r" {3,}|\t"), "p", d.trim("p")), "p", "p <> ''")
    all_ = f"concat({only(d, before)}, {fields})" if d.spark else f"list_concat({only(d, before)}, {fields})"
    return f"CASE WHEN {cond} = '' OR {after} = '' OR ({follow}) OR length({before}) <= 5 THEN {only(d, x)} ELSE {all_} END"


def compound_label(d: Dialect, x: str) -> str:
    """`Apt# State` as two labels, where both words are known ones and they make no known label together."""
    word = rf"({FIELD_KEYWORDS})#?"
    pair = d.has(x, rf"^{word} +{word}$", ci=True)
    joined = d.has(x, r"^[A-Z][a-z]+#?[A-Z][a-z]+#?$") + " AND " + d.has(x, rf"^{word}{word}$", ci=True)
    return f"CASE WHEN {d.any_of(f'lower({x})', WHOLE_LABELS)} THEN {only(d, x)} WHEN {pair} THEN {d.split(x, ' +')} WHEN {joined} THEN {d.split(d.sub(x, r'([a-z]#?)([A-Z])', chr(36) + '1 ' + chr(36) + '2'), ' ')} ELSE {only(d, x)} END"


def bullet_option(d: Dialect, x: str) -> str:
    """The option of a line that is one bullet or box; null if it isn't."""
    plain = d.trim(d.sub(d.sub(d.trim(x), rf"^({L.BOX})[ ]+", ""), r"^[ ]*[-*•·] +", ""))
    named = d.case([("lower(bare) IN ('yes', 'y')", "'Yes'"), ("lower(bare) IN ('no', 'n')", "'No'"), ("bare <> ''", "bare")], "NULL")
    named = d.let(plain, "plain", d.let(T.clean_token(d, "plain"), "bare", named))
    return f"CASE WHEN {d.has(x, rf'^ *([-*•·]|{L.BOX}) +')} AND {d.count(x, L.BOX)} <= 1 THEN {named} END"


def spaced_labels(d: Dialect, x: str) -> str:
    """Labels of a signature block that stand in columns, ten blanks or more apart; two at least."""
    parts = d.filter(d.map(d.split(x, r" {10,}"), "p", d.trim("p")), "p", f"length({d.sub('p', '[_ ]', '')}) >= 2 AND {d.has('p', SIGNATURE_LABELS, ci=True)} AND length({T.slugify(d, 'p')}) >= 3")
    return f"CASE WHEN {d.has(x, ' {10,}')} AND {d.size(parts)} >= 2 THEN {parts} ELSE {none(d)} END"


def is_boxed_question(d: Dialect, x: str) -> str:
    """A line such as `[ ] Yes, send me text alerts`, a question of its own rather than an option."""
    return d.has(x, rf"^ *({L.BOX}) *(Yes|No)[ ,]+[^ ,].{{9,}}$", ci=True)


def inline_box_text(d: Dialect, x: str) -> str:
    """Title of a line such as `[ ] Yes, send me text alerts`; null for a plain option."""
    answer, rest = (d.trim(d.first(x, rf"^ *({L.BOX}) *(Yes|No)[ ,]+(.*)$", i, ci=True)) for i in (2, 3))
    return f"CASE WHEN length({rest}) >= 10 AND NOT {d.has(rest, '^[a-z] +[A-Z]')} THEN concat({d.title(answer)}, ', ', {T.clean_title(d, rest)}) END"


def id_and_ssn(d: Dialect, x: str) -> str:
    """Both keys of a line that asks for an insurance number and a social security number."""
    t = d.sub(T.spaced_plain(d, d.sub(x, "#", " number ")), " +", " ")
    keys = d.array(["insurance_id_number", "ssn"])
    return f"CASE WHEN {d.has(t, ID_WORDS)} AND {d.has(t, SSN_WORDS)} THEN {keys} ELSE {none(d)} END"


def is_condition(d: Dialect, x: str, tokens: tuple[str, ...] = CONDITION_TOKENS) -> str:
    """Whether an option's name looks like a medical condition."""
    return d.let(T.plain(d, x), "cond", d.any_of("cond", tokens))


def is_conditions_field(d: Dialect, kind: str, options: str) -> str:
    """A drop-down of eight options or more, of which three look like conditions. options: names, `|` between them."""
    names = d.filter(d.split(options, r"\|"), "o", is_condition(d, "o", CONTROL_TOKENS))
    return f"({kind} = 'dropdown' AND {d.size(d.split(options, r'\|'))} >= 8 AND {d.size(names)} >= 3)"


def is_hear_about(d: Dialect, x: str) -> str:
    return d.has(x, HEAR_ABOUT, ci=True)
