"""Normalisation of text: ligatures, glyphs, spacing, OCR confusions, labels, titles and keys."""

from __future__ import annotations

from collections.abc import Callable

from .dialect import Dialect

# What each rule replaces.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st", "Ꜳ": "AA", "ꜳ": "aa"}
BOXES = {"☐": "[ ] ", "□": "[ ] ", "■": "[ ] ", "❒": "[ ] ", "◻": "[ ] ", "◽": "[ ] ", "▪": "[ ] ", "✗": "[ ] ", "✘": "[ ] ", "¨": "[ ] ", "☑": "[x] ", "✓": "[x] ", "✔": "[x] ", "•": "• ", "·": "• "}
LABEL_FIXES = {
    "ph0ne": "phone", "ema1l": "email", "adress": "address", "b1rthdate": "birthdate", "bir thdate": "birthdate", "soc1al": "social", "secur1ty": "security", "pat1ent": "patient", "pat ient": "patient",
    "insur ance": "insurance", "med1cal": "medical", "h1story": "history", "all ergy": "allergy", "medic ation": "medication", "phys1cian": "physician", "em ergency": "emergency",
    "c0ntact": "contact", "nod ental": "no dental", "dent al": "dental", "howdidyouhearaboutus": "how did you hear about us", "hearaboutus": "hear about us", "dateofbirth": "date of birth", "phonenumber": "phone number", "emailaddress": "email address",
}
TERM_FIXES = (
    (r"\broot\s+can1l\b", "root canal"), (r"\bfill1ng\b", "filling"), (r"\bextr4ction\b", "extraction"), (r"\bimp1ant\b", "implant"), (r"\bperiodont4l\b", "periodontal"), (r"\bte3th\b", "teeth"),
    (r"\bj4w\b", "jaw"), (r"\bpal4te\b", "palate"), (r"\bcav1ty\b", "cavity"), (r"\btart4r\b", "tartar"), (r"\bbled1ng\b", "bleeding"), (r"\bs3nsitivity\b", "sensitivity"), (r"\bp4in\b", "pain"),
    (r"\ball3rg[yi]c?\b", "allergic"), (r"\bm3dicat[i1]ons?\b|\bmedicat1ons?\b", "medications"), (r"\banesthet1c\b", "anesthetic"), (r"\banathesia\b", "anesthesia"), (r"\bdiab3tes\b", "diabetes"), (r"\bhypert3ns[i1]on\b|\bhypertens1on\b", "hypertension"), (r"\bcard1ovasc[a-z]+\b", "cardiovascular"),
    (r"\bph0ne\b", "phone"), (r"\b3ma[i1]l\b|\bema1l\b", "email"), (r"\baddr3ss\b", "address"), (r"\bz1pcode\b", "zipcode"), (r"\bs1gnature\b", "signature"), (r"\bcons3nt\b", "consent"),
)
SPELLING = {"rregular": "Irregular", "hyploglycemia": "Hypoglycemia", "diabates": "Diabetes", "osteoperosis": "Osteoporosis", "artritis": "Arthritis", "rheurnatism": "Rheumatism"}
SYNONYMS = {"date of birth": "dob", "birth date": "dob", "zip code": "zipcode", "e-mail": "email"}
SECTIONS = {
    "Patient Information": ("patient information", "patient info", "patient details", "demographic", "registration"),
    "Insurance": ("insurance", "subscriber", "policy", "carrier", "dental benefit plan"),
    "Medical History": ("medical history", "health history", "medical", "medical conditions", "health conditions"),
    "Medications": ("medication", "medications", "current medicines", "rx"),
    "Allergies": ("allergy", "allergies"),
    "Dental History": ("dental history", "dental information", "dental"),
    "HIPAA": ("hipaa",),
    "Financial Policy": ("financial", "payment policy", "billing"),
    "Emergency Contact": ("emergency contact",),
    "Appointment Policy": ("appointment policy", "cancellation", "missed appointment", "late policy"),
    "Consent": ("consent", "authorization", "informed consent", "release"),
}


def literal_fixes(d: Dialect, x: str, fixes: dict[str, str]) -> str:
    for a, b in fixes.items():
        x = f"replace({x}, {d.lit(a)}, {d.lit(b)})"
    return x


def restore_ligatures(d: Dialect, x: str) -> str:
    return literal_fixes(d, x, LIGATURES)


def collapse_spaced(d: Dialect, x: str) -> str:
    """Runs of four letters or more set apart by single blanks are joined, where two blanks part words: "P h o n e  N o: 5" is
    "Phone No: 5". Fewer single letters stay, so prose keeps its one-letter words."""
    joined = lambda m: f"replace(replace({d.sub(m, '[ ]{2,}', chr(1))}, ' ', ''), {d.lit(chr(1))}, ' ')"
    return d.squeeze(in_matches(d, x, r"\b([A-Za-z] +){3,}[A-Za-z]\b", joined))


def normalize_whitespace(d: Dialect, x: str) -> str:
    """A blank after punctuation that a letter follows; one blank for each run."""
    return d.squeeze(d.sub(x, r"([.:,;])([A-Za-z])", "$1 $2"))


def fix_label_characters(d: Dialect, x: str) -> str:
    """Digits read for letters in labels: 0 for o, 1 for l, 5 for S at the start."""
    for a, b in LABEL_FIXES.items():
        x = d.sub(x, a, b, ci=True)
    x = d.sub(x, r"\b0([a-z])", "O$1")
    x = d.sub(d.sub(x, r"([a-z])0([a-z])", "$1o$2"), r"([a-z])1([a-z])", "$1l$2")
    return d.sub(x, r"\b5([a-z])", "S$1")


def preprocess(d: Dialect, x: str, label: bool = False) -> str:
    """Ligatures, spacing and, for labels, character confusions."""
    x = normalize_whitespace(d, restore_ligatures(d, x))
    return fix_label_characters(d, x) if label else x


def clean_checkboxes(d: Dialect, x: str) -> str:
    """Boxes that OCR garbled, as `[ ]`; a checked box is `[x]`; line ends stay."""
    x = d.sub(x, r"\b[OoCc][yj](Yes)", "[ ] $1")
    x = d.sub(x, r"\[[JCL](Yes)", "[ ] $1", ci=True)
    x = d.sub(x, r"\b[Cc][lI](Yes)", "[ ] $1")
    x = d.sub(x, r"(Yes)[ \t]*[\]\[JL\-]+[ \t]*(No)", "$1 [ ] $2")
    x = d.sub(x, r"\[\[+", "[ ]")
    x = d.sub(x, r"\[(Yes|No)\b", "[ ] $1", ci=True)
    x = d.sub(x, r"\[[ \t]*[xX][ \t]*\]", "[x]")
    x = d.sub(x, r"\[[ \t]*([A-Za-wyzA-WYZ]|[A-Za-z]{2})[ \t]*\]", "[ ]")
    x = d.sub(x, r"[ \t]*\[[ \t]*(x?)\][ \t]*", " [$1] ")
    x = d.sub(x, r"\[\]", "[ ]")
    return d.sub(x, r"[ \t]{2,}", " ")


def is_checked(d: Dialect, x: str) -> str:
    return d.has(x, r"\[[xXJ]\]|☑|✓|✔")


def fix_terms(d: Dialect, x: str) -> str:
    """Known terms with one misread character; words that are right keep their case."""
    for pattern, to in TERM_FIXES:
        x = d.sub(x, pattern, to, ci=True)
    return x


def fix_phones(d: Dialect, x: str) -> str:
    """O, I and l within telephone numbers, as digits, wherever they stand in a number."""
    shape = r"\(?[0-9OoIl]{3}\)?[-. ]?[0-9OoIl]{3}[-. ][0-9OoIl]{4}"
    return in_matches(d, x, shape, lambda m: f"CASE WHEN {d.count(m, '[0-9]')} >= 6 THEN translate({m}, 'OoIl', '0011') ELSE {m} END")


def fix_dates(d: Dialect, x: str) -> str:
    """Slashes read as I between groups of digits that make a date, and O, I and l within a date's groups."""
    x = d.sub(x, r"\b([0-9]{1,2})[/I]([0-9]{1,2})[/I]([0-9]{2,4})\b", "$1/$2/$3")
    return in_matches(d, x, r"\b[0-9OoIl]{1,2}[/-][0-9OoIl]{1,2}[/-][0-9OoIl]{4}\b", lambda m: f"CASE WHEN {d.count(m, '[0-9]')} >= 4 THEN translate({m}, 'OoIl', '0011') ELSE {m} END")


def in_matches(d: Dialect, x: str, pattern: str, change: Callable[[str], str]) -> str:
    """x with each match of a pattern changed: matches are marked, the text cut at the marks, and every other part changed."""
    mark = chr(2)
    parts = d.split(d.sub(x, f"({pattern})", f"{mark}$1{mark}"), mark)
    if d.spark:
        changed = f"transform({parts}, (m, i) -> CASE WHEN i % 2 = 1 THEN {change('m')} ELSE m END)"
    else:
        changed = f"list_transform({parts}, lambda m, i: CASE WHEN i % 2 = 0 THEN {change('m')} ELSE m END)"
    return f"CASE WHEN {d.has(x, pattern)} THEN {d.join(changed, '')} ELSE {x} END"


def normalize_glyphs(d: Dialect, x: str) -> str:
    """Box and bullet glyphs as `[ ]`, `[x]` and a bullet; a lone `!` before a word is a box."""
    return d.sub(literal_fixes(d, x, BOXES), r"(^|[ \t])![ \t]+([A-Za-z0-9])", "$1[ ] $2")


def correction_counts(d: Dialect, x: str) -> dict[str, str]:
    """Measures of how much there is to correct."""
    return {
        "ligatures": d.count(x, "[" + "".join(LIGATURES) + "]"),
        "wide_spaces": d.count(x, r"[ \t\r\n]{2,}"),
        "confusions": d.count(x, r"[0-9][a-z]|[a-z][0-9]"),
        "chars": f"length({x})",
    }


def section_name(d: Dialect, x: str) -> str:
    """The section whose keywords a heading has most of; of equals the first; without any General."""
    scores = {s: d.hits("low", k) for s, k in SECTIONS.items()}
    best = d.let("greatest(" + ", ".join(scores.values()) + ")", "most", d.case([("most = 0", "'General'"), *((f"{v} = most", d.lit(s)) for s, v in scores.items())], "'General'"))
    return d.let(f"lower({collapse_spaced(d, x)})", "low", d.case([(d.contains("low", "signature"), "'Signature'")], best))


def separate_blanks(d: Dialect, x: str) -> str:
    """`Label____` as `Label: ___`."""
    y = d.sub(x, r"([A-Za-z][A-Za-z ]{1,30})_{3,}", "$1: ___")
    y = d.sub(y, r"([A-Za-z][A-Za-z ]{1,30}):_{3,}", "$1: ___")
    y = d.sub(y, r"([A-Za-z][A-Za-z ]{1,30}?) *[(\[]_{3,}[)\]]", "$1: ___")
    y = d.sub(y, r"_{3,} *_{3,} *_{3,}", "___")
    y = d.sub(y, r":: *", ": ")
    return f"CASE WHEN {d.contains(x, '___')} THEN {y} ELSE {x} END"


def clean_title(d: Dialect, x: str) -> str:
    """A field's title without boxes, date templates, blanks to fill and trailing marks."""
    x = d.sub(x, r"\[ *\]|\[x\]|☐|☑|□|■|❒|◻|✓|✔|✗|✘", "")
    x = d.sub(d.sub(x, r"^![ ]*", ""), r":? */ */ *$", "")
    x = d.squeeze(d.sub(x, r"_{3,}", ""))
    x = d.sub(x, r"[. ]*-( *-)* *$", "")
    return d.trim(d.sub(x, r"[: ]+$", ""))


def clean_token(d: Dialect, x: str) -> str:
    t = d.sub(d.sub(d.squeeze(x), r"^[ \-–—:\t]+", ""), r"[ \-–—:\t]+$", "")
    return d.case([(f"{t} = {d.lit(a)}", d.lit(b)) for a, b in SPELLING.items()], t)


def plain(d: Dialect, x: str) -> str:
    """Lower case without punctuation, for comparison."""
    return d.squeeze(d.sub(f"lower(coalesce({x}, ''))", r"[^\p{L}\p{N}_ \t\r\n]", ""))


def option_name(d: Dialect, x: str) -> str:
    return plain(d, clean_token(d, x))


def spaced_plain(d: Dialect, x: str) -> str:
    """Lower case with punctuation as blanks."""
    return d.squeeze(d.sub(f"lower(coalesce({x}, ''))", r"[^\p{L}\p{N}_]+", " "))


def match_text(d: Dialect, x: str) -> str:
    """A title as the catalogue knows it: synonyms replaced, punctuation gone, trimmed last."""
    return d.squeeze(d.sub(literal_fixes(d, f"lower(coalesce({x}, ''))", SYNONYMS), r"[^\p{L}\p{N}_ \t\r\n]", ""))


def tokens(d: Dialect, x: str) -> str:
    """Distinct tokens, sorted; none of an empty text."""
    return d.filter(d.distinct(d.split(spaced_plain(d, x), " ")), "t", "t <> ''")


def key_shape(d: Dialect, s: str, most: int) -> str:
    """A text of words as a key: one underscore between words, not empty, not starting with a digit, cut at a word."""
    s = d.sub(d.sub(d.sub(s, r"[^A-Za-z0-9_ \t\r\n]", ""), r"[ \t\r\n_]+", "_"), r"^_+|_+$", "")
    named = f"CASE WHEN w = '' THEN 'q' WHEN {d.has('w', '^[0-9]')} THEN concat('q_', w) ELSE w END"
    head = f"substr(k, 1, {most})"
    at_word = d.sub(head, r"_[^_]*$", "")
    cut = f"CASE WHEN length(k) <= {most} THEN k WHEN {d.contains(head, '_')} AND length({at_word}) > {most // 2} THEN {at_word} ELSE {head} END"
    return d.let(s, "w", d.let(named, "k", cut))


def slugify(d: Dialect, x: str, most: int = 64) -> str:
    """A field's key from its title."""
    return key_shape(d, literal_fixes(d, f"lower({d.squeeze(x)})", {**{k: v for k, v in LIGATURES.items()}, "–": "-", "—": "-"}), most)


def catalog_key(d: Dialect, x: str) -> str:
    return f"substr({key_shape(d, match_text(d, x), 200)}, 1, 64)"


def repair_key(d: Dialect, x: str) -> str:
    """A dictionary key such as `1.under_care` or `DOB-2` as a valid one."""
    return key_shape(d, d.sub(f"lower({x})", r"[^a-z0-9]+", "_"), 64)


def clean_option(d: Dialect, x: str) -> str:
    """Option text without repeated words, without a long tail after a slash, and with known misreadings mended."""
    words = d.split(d.squeeze(x), " ")
    bare = lambda w: d.sub(f"lower({w})", r"^[.,;:]+|[.,;:]+$", "")
    if d.spark:
        kept = f"filter({words}, (w, i) -> i = 0 OR {bare('w')} <> {bare(f'element_at({words}, i)')})"
    else:
        kept = f"list_filter({words}, lambda w, i: i = 1 OR {bare('w')} <> {bare(f'list_extract({words}, i - 1)')})"
    t = d.join(kept, " ")
    head, tail = d.trim(d.first(t, r"^([^/]*)/", 1)), d.trim(d.first(t, r"^[^/]*/(.*)$", 1))
    messy = f"length({head}) >= 3 AND {d.has(head, '^[A-Z]')} AND {d.words(tail)} > 2"
    t = f"CASE WHEN {messy} THEN {head} ELSE {t} END"
    for a, b in (("rregular", "Irregular"), ("rheurnatism", "Rheumatism")):
        t = d.sub(t, rf"\b{a}\b", b, ci=True)
    return t


def html_rows(d: Dialect, x: str, end: str = "</(li|p|tr)>") -> str:
    """The text of an HTML element's rows: cut after each row, tags and runs of white space gone, empty rows left out."""
    strip = lambda v: d.squeeze(d.sub(d.sub(v, r"<(script|style)[^>]*>[^<]*</(script|style)>", " "), r"<[^>]*>", " "))
    return d.filter(d.map(d.split(x, end), "r", strip("r")), "r", "r <> ''")


def language_list(d: Dialect, x: str) -> str:
    return d.filter(d.map(d.split(x, ","), "l", d.trim("l")), "l", "l <> ''")
