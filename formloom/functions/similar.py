"""Likeness of short texts: longest matching blocks as a pass over a work list, and neighbourhoods of deletions."""

from __future__ import annotations

from .dialect import Dialect

#: A block's length and place in one number: length * PLACES + (PLACES - place).
PLACES = 100_000
BETWEEN, AFTER = "\x01", "\x02"


def longest_block(d: Dialect, x: str, y: str) -> str:
    """Length and place in x of the longest text that x and y share, the first of equals, in one number (PLACES); below PLACES
    if they share none. From a place on, the lengths that y holds are all up to the longest, so they are counted."""
    if d.spark:
        longest = f"size(filter(sequence(1, length({x}) - i + 1), n -> contains({y}, substr({x}, i, n))))"
        return f"array_max(transform(sequence(1, length({x})), i -> cast({longest} as bigint) * {PLACES} + {PLACES} - i))"
    longest = f"len(list_filter(range(1, length({x}) - i + 2), lambda n: contains({y}, substr({x}, cast(i as bigint), cast(n as bigint)))))"
    return f"list_max(list_transform(range(1, length({x}) + 1), lambda i: cast({longest} as bigint) * {PLACES} + {PLACES} - i))"


def ratios(d: Dialect, pairs: str, longest: int = 400) -> str:
    """a, b, ratio: Ratcliff-Obershelp similarity of the distinct pairs of texts (a, b) that aren't empty, up to `longest`
    characters (titles are shorter; longer ones are no titles and have no row).

    A pair's work list begins with both texts. Each two steps take its first item, find the longest block that both parts
    share, and put what stands left and right of it on the list, which is empty after twice as many items as the shorter text
    has characters, and one. The similarity is twice the characters in blocks by all characters.
    """
    cut, end = d.code(BETWEEN), d.code(AFTER)
    into = "div" if d.spark else "//"
    steps = "2 * (2 * least(length(a), length(b)) + 1)"
    listed = f"sequence(0, {steps})" if d.spark else f"range({steps} + 1)"
    rows = d.exploded(f"(SELECT DISTINCT a, b, concat(a, {cut}, b) AS pair FROM ({pairs}) p WHERE a <> '' AND b <> '' AND length(a) <= {longest} AND length(b) <= {longest}) q", listed, "pair", "k", pos="step")
    head = f"split_part(s.work, {end}, 1)"
    x, y = f"split_part({head}, {cut}, 1)", f"split_part({head}, {cut}, 2)"
    size, at = f"(s.block {into} {PLACES})", f"({PLACES} - s.block % {PLACES})"
    block = d.let(x, "x_", d.let(y, "y_", longest_block(d, "x_", "y_")))
    both = lambda a, b: f"CASE WHEN {a} <> '' AND {b} <> '' THEN concat({a}, {cut}, {b}, {end}) ELSE '' END"
    int_ = lambda e: f"cast({e} as int)" if d.spark else f"cast({e} as bigint)"
    where = f"instr(y_, substr(x_, {int_(at)}, {int_(size)}))"
    parts = f"concat({both(f'substr(x_, 1, {int_(at + ' - 1')})', 'substr(y_, 1, j_ - 1)')}, {both(f'substr(x_, {int_(at + ' + ' + size)})', f'substr(y_, {int_('j_ + ' + size)})')})"
    split = d.let(x, "x_", d.let(y, "y_", d.let(where, "j_", parts)))
    rest = f"substr(s.work, length({head}) + 2)"
    state = {
        "work": ("string", "''", f"CASE WHEN x.step = 0 THEN concat(x.pair_, {end}) WHEN s.work = '' OR x.step % 2 = 1 THEN s.work WHEN {size} = 0 THEN {rest} ELSE concat({split}, {rest}) END"),
        "block": ("bigint", "0", f"CASE WHEN x.step % 2 = 1 AND s.work <> '' THEN {block} ELSE 0 END"),
        "shared": ("bigint", "0", f"CASE WHEN x.step > 0 AND x.step % 2 = 0 AND s.work <> '' THEN s.shared + {size} ELSE s.shared END"),
    }
    folded = d.fold(f"SELECT pair, step, CASE WHEN step = 0 THEN pair END AS pair_ FROM ({rows}) r", ["step"], {"step": "bigint", "pair_": "string"}, state, {"shared": "bigint"}, [("x.step = -1", {"shared": "s.shared"})], {"step": "-1", "pair_": "NULL"}, key="pair")
    a, b = f"split_part(pair, {cut}, 1)", f"split_part(pair, {cut}, 2)"
    return f"SELECT {a} AS a, {b} AS b, 2.0 * cast(shared as double) / (length(pair) - 1) AS ratio FROM ({folded}) f"


def deletions(d: Dialect, x: str, longest: int = 40) -> str:
    """Array of x and of what is left of it without one character or two (without one, if x has five or fewer); of a text of
    over `longest` characters only itself."""
    one = lambda v: d.map(f"sequence(1, length({v}))" if d.spark else f"range(1, length({v}) + 1)", "i", f"concat(substr({v}, 1, cast(i as int) - 1), substr({v}, cast(i as int) + 1))")
    twice = f"flatten({d.map('one_', 'v', one('v'))})"
    join = lambda *a: f"concat({', '.join(a)})" if d.spark else f"list_concat({', '.join(a)})"
    itself = f"array({x})" if d.spark else f"[{x}]"
    return d.distinct(d.let(one(x), "one_", f"CASE WHEN length({x}) > {longest} OR length({x}) < 2 THEN {itself} WHEN length({x}) <= 5 THEN {join(itself, 'one_')} ELSE {join(itself, 'one_', twice)} END"))


def likeness(d: Dialect, x: str, y: str) -> str:
    """1 less the edits by all characters, where a replaced character counts twice, as in a ratio of matching ones."""
    return f"(1 - (2 * levenshtein({x}, {y}) - abs(length({x}) - length({y}))) / cast(length({x}) + length({y}) as double))"


def close_pairs(d: Dialect, texts: str, known: str, least: float = 0.85) -> str:
    """text, label, alike: each distinct text (column `text`) with the labels (column `label`) that are two edits or fewer away
    and alike by `least` or more.

    Texts and labels meet by equality of what deletions leave of them, as any two within two edits do; the edit distance is
    computed of those that meet only, so no text is compared with all labels.
    """
    left = d.exploded(f"(SELECT DISTINCT text FROM ({texts}) t WHERE text <> '') w", deletions(d, "text"), "text", "left_over", pos="k")
    right = d.exploded(f"(SELECT DISTINCT label FROM ({known}) n WHERE label <> '') w", deletions(d, "label"), "label", "left_over", pos="k")
    met = f"SELECT DISTINCT l.text, r.label FROM ({left}) l JOIN ({right}) r ON l.left_over = r.left_over"
    return f"SELECT text, label, cast(round({likeness(d, 'text', 'label')}, 6) as double) AS alike FROM ({met}) m WHERE levenshtein(text, label) <= 2 AND {likeness(d, 'text', 'label')} >= {least}"


# The words that labels are made of, as far as they are corrected.
LABEL_WORDS = (
    "phone", "email", "address", "city", "state", "zip", "name", "first", "last", "middle", "date", "birth", "social", "security", "patient", "insurance", "medical", "history", "allergy", "medication", "physician",
    "emergency", "contact", "relationship", "gender", "age", "occupation", "employer", "referred", "referral", "signature",
)


def corrected_words(d: Dialect, words: str) -> str:
    """word, corrected, alike: the distinct words (column `word`) that are no label word but close to one, in its case."""
    low = f"SELECT DISTINCT lower(word) AS text FROM ({words}) w"
    known = f"SELECT * FROM (VALUES {', '.join(f'({d.lit(w)})' for w in LABEL_WORDS)}) v(label)"
    best = f"SELECT text, label, alike, row_number() OVER (PARTITION BY text ORDER BY alike DESC, label) AS n FROM ({close_pairs(d, low, known)}) c"
    cased = d.case([("word = upper(word)", "upper(label)"), (f"word = {d.title('word')}", d.title("label"))], "label")
    return f"SELECT word, {cased} AS corrected, alike FROM (SELECT DISTINCT word FROM ({words}) w) a JOIN ({best}) b ON lower(word) = b.text AND b.n = 1 WHERE b.text <> b.label"
