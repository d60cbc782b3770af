"""Fields as records: reading them off lines, numbering keys, removing duplicates, islands of consent, order."""

from __future__ import annotations

from ..functions import fields as D
from ..functions import lines as L
from ..functions import questions as Q
from ..functions import text as T
from ..functions.dialect import Dialect
from . import grids as G
from . import known as K
from . import lines as O
from . import parser as P
from . import splits as S

#: What a field carries through the fold that nests it, with types.
CARRIED = {"pos": "bigint", "sub": "bigint", "key": "string", "title": "string", "section": "string", "type": "string", "input_type": "string", "n_options": "int", "options": "string", "follow_up": "int", "html": "string"}
#: Columns of converted().
CONVERTED = "doc_id, pos, sub, place, key, title, section, type, input_type, n_options, options, follow_up, html, parent, depth, answer"
COLUMNS = "doc_id, pos, sub, key, title, section, type, input_type, n_options, options, follow_up"


def fields(d: Dialect, source: str) -> str:
    """The fields of some lines: labels with colon or blank, boxes and signatures in columns, typed, with section, key, options
    and whether a follow-up is asked for. The lines are read once and dealt once, by document; in Spark they are counted
    before, so that the rules run once for each line and part that many documents share (see known)."""
    dropped = f"({L.is_metadata(d, 'line')} OR {L.is_numbered_item(d, 'line')} OR {L.is_underline(d, 'line')} OR ({P.is_guidance(d, 'line')} AND NOT {d.has('line', '[:?] *$')}))"
    title = T.clean_title(d, f"CASE WHEN {L.has_box(d, 'part')} THEN {S.option_label(d, 'part')} WHEN {d.contains('part', ':')} THEN {d.first('part', '^([^:]*):', 1)} ELSE part END")
    follows = f"cast({S.yes_no_follow_up(d, 'part')} as int)"
    n_options = f"CASE WHEN options = '' THEN 0 ELSE {d.count('options', '[|]')} + 1 END"
    kind = f"CASE WHEN {L.is_signature(d, 'title')} THEN 'block_signature' ELSE {D.field_type(d, 'title', 'n_options')} END"
    base = D.guardian_key(d, "title", T.slugify(d, "title"))
    if d.spark:
        rules = O.section_rules(d) | {"dropped": dropped, "parts": S.field_parts(d, "line")}
        steps = [{"title": title, "options": S.options_text(d, "part"), "follow_up": follows}, {"n_options": n_options}, {"type": kind, "input_type": D.input_type(d, "title"), "base_key": base}]
        lines = K.learn(d, source, ["line"], [rules])
        parts = K.stored(d, K.layered(f"SELECT DISTINCT part FROM ({lines}) l LATERAL VIEW explode(parts) AS part WHERE length(part) <= {K.LONGEST}", steps), 1)
        placed = O.sections_of(d, K.look_up(source, lines, ["line"], [rules]), "dropped, parts, n_fields, n_info")
        kept = f"SELECT doc_id, pos, section, scope, parts FROM (SELECT *, {O.informs(d, 'n_fields', 'n_info')} AS informs FROM ({placed}) s) i WHERE NOT informs AND heading IS NULL AND NOT dropped"
        expanded = d.exploded(f"({kept}) k", "parts", "doc_id, pos, section, scope", "part", pos="sub")
        typed = f"SELECT * FROM ({K.look_up(expanded, parts, ['part'], steps)}) p WHERE length(title) > 1"
        known = f"SELECT title, key, type, input_type, n_options, options FROM ({parts}) p LATERAL VIEW explode(array(base_key, concat(base_key, '__primary'), concat(base_key, '__secondary'))) AS key WHERE length(title) > 1"
        return K.Known(f"SELECT doc_id, pos, sub, {D.scoped_key(d, 'base_key', 'section', 'scope')} AS key, title, section, type, input_type, n_options, options, follow_up FROM ({typed}) t", known)
    kept = f"SELECT doc_id, pos, line, section, scope FROM (SELECT *, {O.is_information_sheet(d)} AS informs FROM ({O.sections(d, source)}) s) i WHERE NOT informs AND heading IS NULL AND NOT {L.is_metadata(d, 'line')} AND NOT {L.is_numbered_item(d, 'line')} AND NOT {L.is_underline(d, 'line')} AND NOT ({P.is_guidance(d, 'line')} AND NOT {d.has('line', '[:?] *$')})"
    expanded = d.exploded(f"({kept}) k", S.field_parts(d, "line"), "doc_id, pos, section, scope", "part", pos="sub")
    named = f"SELECT doc_id, pos, sub, section, scope, part, {title} AS title, {S.options_text(d, 'part')} AS options, {follows} AS follow_up FROM ({expanded}) e"
    counted = f"SELECT *, {n_options} AS n_options FROM ({named}) n WHERE length(title) > 1"
    typed = f"SELECT *, {kind} AS type, {D.input_type(d, 'title')} AS input_type FROM ({counted}) c"
    key = D.scoped_key(d, base, "section", "scope")
    return f"SELECT doc_id, pos, sub, {key} AS key, title, section, type, input_type, n_options, options, follow_up FROM ({typed}) t"


def numbered_keys(d: Dialect, source: str) -> str:
    """Keys made unique: the n-th of a document's equal keys ends in _n; a signature's key stays as it is."""
    return f"""SELECT doc_id, pos, sub, CASE WHEN n > 1 AND key <> 'signature' THEN concat(key, '_', cast(n as varchar(10))) ELSE key END AS unique_key, title FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY pos, sub) AS n FROM ({source}) f) r"""


def first_of(d: Dialect, source: str, keys: str, order: str, columns: str = COLUMNS) -> str:
    """The first row, by an order, of those with equal keys. Of documents' keys there are about as many as rows, and a window of
    each costs Spark more than its rows do; so there it is one of a document's rows by key, in which a key's first row is the
    one after another key."""
    group, *rest = keys.split(", ")
    if d.spark and rest:
        over = f"OVER (PARTITION BY {group} ORDER BY {', '.join(rest)}, {order})"
        again = " AND ".join(f"{k} <=> lag({k}) {over}" for k in rest)
        return f"SELECT {columns} FROM (SELECT *, row_number() {over} AS n, {again} AS again FROM ({source}) f) r WHERE n = 1 OR NOT again"
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM ({source}) f) r WHERE n = 1"


def semantic_duplicates(d: Dialect, source: str) -> str:
    """Inputs of one title, section and input type once."""
    plain = T.plain(d, "title")
    if d.spark:
        source, plain = K.ruled(d, source, ["title"], {"plain": plain}), "plain"
    return f"""SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, type, CASE WHEN type = 'input' THEN {plain} ELSE concat(cast(pos as varchar(20)), '.', cast(sub as varchar(20))) END, section, input_type ORDER BY pos, sub) AS n
  FROM ({source}) f) r WHERE n = 1"""


def in_preferred_section(d: Dialect, source: str) -> str:
    """Of equal keys the one in the section where its key belongs, else the first."""
    if d.spark:
        source = at_home(d, source)
    home = "coalesce(home, section)" if d.spark else D.home_section(d, "key", "title", "section")
    return first_of(d, source, "doc_id, key", f"CASE WHEN section = {home} THEN 0 ELSE 1 END, pos, sub")


def at_home(d: Dialect, source: str) -> str:
    """Fields with the section that their words belong to (`home`), null where they stay."""
    return K.ruled(d, source, ["key", "title"], {"home": D.home_section(d, "key", "title", "cast(NULL as string)")})


def most_informed(d: Dialect, source: str) -> str:
    """Of equal keys the one that says most: options and length of title; the earliest of equals."""
    return first_of(d, source, "doc_id, key", "CASE WHEN n_options > 0 THEN 1 ELSE 0 END + length(title) DESC, pos, sub")


def islands(d: Dialect, source: str, member: str, title: str, least: int = 1) -> str:
    """Runs of rows that `member` holds for, each as one terms field with the texts as paragraphs; other rows stay alone."""
    return f"""SELECT doc_id, min(pos) AS pos, count(*) AS n_rows, CASE WHEN is_in AND count(*) > {least} THEN {d.lit(title)} ELSE min(title) END AS title,
    CASE WHEN is_in AND count(*) > {least} THEN 'terms' ELSE min(type) END AS type, concat('<p>', {d.ordered_join("title", "place", "</p><p>")}, '</p>') AS html FROM (
    SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY place) AS island FROM (
      SELECT *, CASE WHEN is_in AND lag(is_in) OVER (PARTITION BY doc_id ORDER BY place) THEN 0 ELSE 1 END AS starts FROM (
        SELECT doc_id, pos, {d.place("pos", "sub")} AS place, title, type, {member} AS is_in FROM ({source}) f) a) b) c GROUP BY doc_id, island, is_in"""


def consent_islands(d: Dialect, source: str) -> str:
    return islands(d, source, f"(type = 'terms' OR {L.is_consent_paragraph(d, 'title')})", "Terms and Conditions")


def procedure_islands(d: Dialect, source: str) -> str:
    return islands(d, source, f"(type = 'terms' OR {L.is_procedure_text(d, 'title')})", "Procedure Information and Consent")


def risk_islands(d: Dialect, source: str) -> str:
    """Runs of risk items; neither a heading nor any item is lost."""
    return islands(d, source, L.is_risk_item(d, "title"), "Risks and Complications")


def inferred_sections(d: Dialect, source: str) -> str:
    """General rows get the section of their words, else the last one that words gave."""
    best = D.best_section(d, "title", "key")
    if d.spark:
        source, best = K.ruled(d, source, ["title", "key"], {"worded": best}), "worded"
    last = d.last("best", "PARTITION BY doc_id ORDER BY pos, sub")
    return f"""SELECT doc_id, pos, sub, key, CASE WHEN section NOT IN ('General', 'Signature') THEN section ELSE coalesce(best, CASE WHEN section = 'General' THEN coalesce({last}, 'General') END, section) END AS section FROM (
  SELECT *, CASE WHEN section IN ('General', 'Signature') THEN {best} END AS best FROM ({source}) f) b"""


#: Weights of the fields before and after, by distance; the one before counts a little more.
BEFORE, BEHIND = (13, 7, 5), (12, 6, 4)


def voted_sections(d: Dialect, source: str, columns: str = COLUMNS) -> str:
    """Fields of no section (General) with the one that their words tell, else that of most votes of their neighbours.

    Neighbours vote if their own section is known, by headings or words, up to three fields before and behind, nearer ones
    more; never across a change point, where the heading's section changes. The fields of other sections stay.
    """
    over = "OVER (PARTITION BY doc_id ORDER BY pos, sub)"
    told = f"coalesce({D.told_section(d, 'title', 'key')}, {D.best_section(d, 'title', 'key')})"
    if d.spark:
        source, told = K.ruled(d, source, ["title", "key"], {"told_by": told}), "told_by"
    own = f"CASE WHEN section <> 'General' THEN section ELSE {told} END"
    changes = f"SELECT *, CASE WHEN section <> lag(section) {over} THEN 1 ELSE 0 END AS changed FROM (SELECT *, {own} AS known FROM ({source}) f) k"
    parted = f"SELECT *, sum(changed) {over} AS part FROM ({changes}) c"
    near = [(f"{way}{i + 1}", w[i], f"{fn}(known, {i + 1}) {over}", f"{fn}(part, {i + 1}) {over}") for way, fn, w in (("b", "lag", BEFORE), ("a", "lead", BEHIND)) for i in range(3)]
    seen = f"SELECT *, {', '.join(f'{k} AS {n}, {p} AS {n}_part' for n, _, k, p in near)} FROM ({parted}) p"
    votes = {s: "(" + " + ".join(f"CASE WHEN {n} = {d.lit(s)} AND {n}_part = part THEN {w} ELSE 0 END" for n, w, _, _ in near) + ")" for s in D.SECTION_WORDS}
    if d.spark:  # most sections are known, so most votes needn't be counted
        votes = {s: f"CASE WHEN known IS NULL THEN {v} END" for s, v in votes.items()}
    most = f"greatest({', '.join(f'v_{i}' for i in range(len(votes)))})"
    counted = f"SELECT *, {', '.join(f'{v} AS v_{i}' for i, v in enumerate(votes.values()))} FROM ({seen}) s"
    chosen = d.case([(f"{most} = 0", "'General'"), *((f"v_{i} = {most}", d.lit(s)) for i, s in enumerate(votes))], "'General'")
    rest = ", ".join(c.strip() for c in columns.split(",") if c.strip() != "section")
    return f"SELECT {rest}, coalesce(known, {chosen}) AS section FROM ({counted}) v"


# Words of conditions that run together in the title of a broken grid, and what a whole question says.
RUN_WORDS = (
    "therapy", "disease", "disorder", "condition", "illness", "syndrome", "pain", "fever", "bleeding", "valve", "joint", "respiratory", "cardiovascular", "hematologic", "psychiatric", "gastrointestinal", "arthritis",
    "diabetes", "asthma", "seizure", "allergy", "nursing", "teeth", "grinding", "clenching", "sucking", "biting", "chewing", "discolored", "worn", "crooked", "spaces", "overbite", "sensitivity", "anesthesia", "sulfa", "drugs",
)
ASKING = r"\b(please|mark|any|conditions|apply|do you|have you)\b"


def is_run(d: Dialect) -> str:
    """A title that is a run of names: four capitalised words or four words of conditions, and nothing that asks."""
    run = f"{d.count('title', '(^| )[A-Z][^ ]{2,}')} >= 4 OR {d.hits('lower(title)', RUN_WORDS)} >= 4"
    return f"NOT {d.has('lower(title)', ASKING)} AND ({run})"


def is_broken_grid(d: Dialect, run: str = "") -> str:
    """A drop-down of a history whose title is a run of its options' names (run: whether it is)."""
    return f"(section IN ('Medical History', 'Dental History') AND type = 'dropdown' AND n_options >= 2 AND {run or is_run(d)})"


def consolidated(d: Dialect, source: str, columns: str = COLUMNS) -> str:
    """Fields that are parts of one question as that question, at the first one's place, with all their options once: how one
    heard of the practice; the broken grids of a section, two or more with five options or more; the condition fields of a
    section (see merged_conditions). Other fields stay; all is one pass with windows within a document."""
    condition, hear, broken, dump = Q.is_condition(d, "title"), Q.is_hear_about(d, "title"), is_broken_grid(d), L.is_option_dump(d, "title")
    n_conditions = d.size(d.filter(d.split("options", r"[|]"), "o", Q.is_condition(d, "o")))
    if d.spark:
        source = K.ruled(d, K.ruled(d, source, ["title"], {"c_one": condition, "c_hear": hear, "c_dump": dump, "c_run": is_run(d)}), ["options"], {"c_many": n_conditions})
        condition, hear, broken, dump, n_conditions = "c_one", "c_hear", is_broken_grid(d, "c_run"), "c_dump", "c_many"
    single = f"type IN ('checkbox', 'radio', 'input', 'dropdown') AND n_options <= 1 AND {condition}"
    history = "section IN ('Medical History', 'Dental History', 'General', 'Allergies')"
    listed = f"n_options >= 5 AND {n_conditions} >= 3"
    kind = d.case([(hear, "'hear'"), (broken, "'broken'"), (f"{history} AND ({dump} OR ({listed}))", "'grid'"), (f"{history} AND ({single})", "'single'")], "NULL")
    classed = f"SELECT *, CASE WHEN part_kind IN ('grid', 'single') THEN concat('conditions|', section) WHEN part_kind = 'broken' THEN concat('broken|', section) ELSE part_kind END AS whole FROM (SELECT *, {kind} AS part_kind FROM ({source}) f) k"
    over = "OVER (PARTITION BY doc_id, whole)"
    option = "CASE WHEN part_kind = 'single' THEN title WHEN part_kind IS NOT NULL THEN options END"
    options = f"collect_list({option}) {over}" if d.spark else all_options(d, over, option)
    count = lambda c: f"sum(CASE WHEN {c} THEN 1 ELSE 0 END) {over}"
    counts = ", ".join(f"{count(d.lit(k) + ' = part_kind')} AS {n}" for n, k in (("n_grids", "grid"), ("n_singles", "single")))
    gathered = f"SELECT *, {options} AS all_options, count(*) {over} AS n_parts, {counts}, row_number() OVER (PARTITION BY doc_id, whole ORDER BY pos, sub) AS nth FROM ({classed}) c"
    if d.spark:  # most fields are no part of a question
        gathered = f"SELECT * EXCEPT (all_options), CASE WHEN whole IS NOT NULL AND n_parts > 1 THEN {all_options(d, '', given='all_options')} END AS all_options FROM ({gathered}) o"
    n_all = f"({d.count('all_options', '[|]')} + 1)"
    joins = f"(whole IS NOT NULL AND n_parts > 1 AND CASE WHEN part_kind = 'hear' THEN true WHEN part_kind = 'broken' THEN {n_all} >= 5 ELSE n_grids >= 1 OR n_singles >= 5 END)"
    title = "CASE WHEN part_kind = 'hear' THEN title WHEN section IN ('Medical History', 'Dental History') THEN concat(section, ' - Please mark any conditions that apply') ELSE concat(section, ' - Please mark any that apply') END"
    keys = d.case([("part_kind = 'hear'", "key"), ("part_kind <> 'broken'", "'medical_conditions'"), ("section = 'Dental History'", "'dental_conditions_consolidated'")], "'medical_conditions_consolidated'")
    made = {"key": keys, "title": title, "type": "CASE WHEN part_kind = 'hear' THEN type ELSE 'dropdown' END", "options": "all_options", "n_options": n_all}
    shown = ", ".join(f"CASE WHEN joined THEN {made[c]} ELSE {c} END AS {c}" if c in made else c for c in (x.strip() for x in columns.split(",")))
    return f"SELECT {shown} FROM (SELECT *, {joins} AS joined FROM ({gathered}) g) j WHERE NOT joined OR nth = 1"


def unique_titles(d: Dialect, source: str) -> str:
    """Generic follow-up titles take the title before; equal titles of a section are numbered."""
    asked = f"CASE WHEN {d.has('lower(title)', '^(if yes|please explain|explain|comments|details|other)')} AND before IS NOT NULL THEN concat(before, ' - ', title) ELSE title END"
    return f"""SELECT doc_id, pos, sub, CASE WHEN n > 1 THEN concat(full_title, ' (', cast(n as varchar(10)), ')') ELSE full_title END AS title FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section, full_title ORDER BY pos, sub) AS n FROM (
    SELECT *, {asked} AS full_title FROM (SELECT *, lag(title) OVER (PARTITION BY doc_id ORDER BY pos, sub) AS before FROM ({source}) f) a) b) c"""


def ordered_sections(d: Dialect, source: str) -> str:
    """Fields with their place in the output: by section, then as they stood."""
    return f"SELECT doc_id, key, section, row_number() OVER (PARTITION BY doc_id ORDER BY {D.section_rank(d, 'section')}, pos, sub) AS place FROM ({source}) f"


def one_signature(d: Dialect, source: str) -> str:
    """Exactly one signature a document: the first stays, and a document without one gets one."""
    if d.spark:  # one pass: the first signature or, without one, the first field
        signs = "type IN ('signature', 'block_signature')"
        ranked = f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN {signs} THEN 0 ELSE 1 END, pos, sub) AS n FROM ({source}) f"
        return f"SELECT doc_id, CASE WHEN {signs} THEN cast(pos as bigint) END AS pos, CASE WHEN {signs} THEN cast(sub as bigint) END AS sub, CASE WHEN {signs} THEN title ELSE 'Signature' END AS title FROM ({ranked}) r WHERE n = 1"
    first = first_of(d, f"SELECT * FROM ({source}) f WHERE type IN ('signature', 'block_signature')", "doc_id", "pos, sub", "doc_id, pos, sub, title")
    missing = f"SELECT a.doc_id, cast(NULL as bigint) AS pos, cast(NULL as bigint) AS sub, 'Signature' AS title FROM (SELECT DISTINCT doc_id FROM ({source}) f) a LEFT JOIN ({first}) s ON a.doc_id = s.doc_id WHERE s.doc_id IS NULL"
    return f"{first} UNION ALL {missing}"


def all_options(d: Dialect, over: str, options: str = "options", given: str = "") -> str:
    """Options of several rows as one text, each once, in order. over: the aggregate's rows, or a window's; given: in Spark a
    list of them that is there already."""
    if d.spark:
        return f"array_join(filter(array_sort(array_distinct(split(array_join({given or f'collect_list({options}) {over}'}, '|'), '[|]'))), o -> o <> ''), '|')"
    return f"array_to_string(list_filter(list_sort(list_distinct(string_split(coalesce(string_agg({options}, '|') {over}, ''), '|'))), lambda o: o <> ''), '|')"


def merged_options(d: Dialect, source: str) -> str:
    """All "how did you hear about us" rows of a document as one, at the first one's place, with the options of all."""
    return f"""SELECT doc_id, min(pos) AS pos, count(*) AS n_merged, {all_options(d, "")} AS options FROM ({source}) f WHERE {Q.is_hear_about(d, "title")} GROUP BY doc_id"""


def merged_conditions(d: Dialect, source: str) -> str:
    """Condition fields of a section as one drop-down: those that hold a grid's options, and five single ones or more."""
    condition, dump, n_conditions = Q.is_condition(d, "title"), L.is_option_dump(d, "title"), d.size(d.filter(d.split("options", r"[|]"), "o", Q.is_condition(d, "o")))
    if d.spark:
        source = K.ruled(d, K.ruled(d, source, ["title"], {"c_one": condition, "c_dump": dump}), ["options"], {"c_many": n_conditions})
        condition, dump, n_conditions = "c_one", "c_dump", "c_many"
    single = f"type IN ('checkbox', 'radio', 'input', 'dropdown') AND n_options <= 1 AND {condition}"
    kind = d.case([(dump, "'grid'"), (f"n_options >= 5 AND {n_conditions} >= 3", "'grid'"), (single, "'single'")], "NULL")
    classed = f"SELECT doc_id, section, pos, kind, CASE WHEN kind = 'single' THEN title ELSE options END AS options FROM (SELECT *, {kind} AS kind FROM ({source}) f WHERE section IN ('Medical History', 'Dental History', 'General', 'Allergies')) k WHERE kind IS NOT NULL"
    return f"""SELECT doc_id, section, min(pos) AS pos, count(*) AS n_merged, 'medical_conditions' AS key, {all_options(d, "")} AS options FROM ({classed}) c
  GROUP BY doc_id, section HAVING {d.count_if("kind = 'grid'")} >= 1 OR {d.count_if("kind = 'single'")} >= 5"""


def continues(d: Dialect) -> str:
    """Whether a title is made of its own options' names and the title `before` asks for a selection."""
    return f"{made_of_options(d)} AND {asks_selection(d, 'before')}"


def made_of_options(d: Dialect) -> str:
    own = d.filter(d.split("options", r"[|]"), "o", "o <> '' AND contains(title, o)")
    return f"{d.count('title', '(^| )[A-Z]')} >= 3 AND NOT {d.contains('title', '?')} AND type IN ('dropdown', 'radio', 'checkbox') AND {d.size(own)} >= 2"


def asks_selection(d: Dialect, title: str) -> str:
    return d.any_of(f"lower({title})", ("allergic", "any of the following", "select", "choose", "check", "mark"))


def continued_options(d: Dialect, source: str) -> str:
    """A row whose title is made of its option names goes into the selection question before it, with its options."""
    order = "OVER (PARTITION BY doc_id, section ORDER BY pos, sub)"
    return f"""SELECT doc_id, min(pos) AS pos, {d.ordered_join("CASE WHEN joins THEN NULL ELSE title END", d.place("pos", "sub"), "")} AS title, count(*) AS n_merged, {all_options(d, "")} AS options FROM (
    SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) {order} AS island FROM (
      SELECT *, coalesce({continues(d)} AND before_options > 0, false) AS joins FROM (SELECT *, lag(title) {order} AS before, lag(n_options) {order} AS before_options FROM ({source}) f) b) j) i
  GROUP BY doc_id, section, island HAVING count(*) > 1"""


def joined_continuations(d: Dialect, source: str, columns: str = COLUMNS) -> str:
    """All fields, those of continued_options() in the question before them."""
    order = "OVER (PARTITION BY doc_id, section ORDER BY pos, sub)"
    marked = f"SELECT *, coalesce({continues(d)} AND before_options > 0, false) AS joins FROM (SELECT *, lag(title) {order} AS before, lag(n_options) {order} AS before_options FROM ({source}) f) b"
    if d.spark:
        ruled = K.ruled(d, K.ruled(d, source, ["title", "type", "options"], {"of_options": made_of_options(d)}), ["title"], {"asks": asks_selection(d, "title")})
        marked = f"SELECT *, coalesce(of_options AND lag(asks) {order} AND lag(n_options) {order} > 0, false) AS joins FROM ({ruled}) f"
    island = f"SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) {order} AS island FROM ({marked}) j"
    over = "OVER (PARTITION BY doc_id, section, island)"
    sized = f"SELECT *, count(*) {over} AS n_rows, {all_options(d, over)} AS all_options FROM ({island}) i"
    if d.spark:  # most questions stand alone, and their options stay as they are
        sized = f"SELECT *, CASE WHEN n_rows > 1 THEN {all_options(d, '', given='options_of')} END AS all_options FROM (SELECT *, count(*) {over} AS n_rows, collect_list(options) {over} AS options_of FROM ({island}) i) n"
    made = {"options": "all_options", "n_options": f"{d.count('all_options', '[|]')} + 1"}
    shown = ", ".join(f"CASE WHEN n_rows > 1 THEN {made[c]} ELSE {c} END AS {c}" if c in made else c for c in (x.strip() for x in columns.split(",")))
    return f"SELECT {shown} FROM ({sized}) s WHERE NOT joins"


def final_types(d: Dialect, source: str) -> str:
    """Fields with options are radio or checkbox in the end; signatures, terms and dates stay."""
    chosen = D.radio_or_checkbox(d, "title", "n_options", "false")
    if d.spark:
        source, chosen = K.ruled(d, source, ["title", "n_options"], {"chosen": chosen}), "chosen"
    return f"""SELECT doc_id, pos, sub, key, CASE WHEN type IN ('block_signature', 'terms', 'date') OR n_options = 0 THEN type ELSE {chosen} END AS type FROM ({source}) f"""


def scored(d: Dialect, source: str, least: float = 0.3) -> str:
    """Matched fields (`score`: of the match) with their confidence, without those below a threshold."""
    return f"SELECT * FROM (SELECT doc_id, pos, sub, key, {D.confidence(d, 'key', 'title', 'type', 'section', 'input_type', 'score')} AS confidence FROM ({source}) f) c WHERE confidence >= {least}"


def converted(d: Dialect, source: str) -> str:
    """The whole chain from raw lines: scrubbed, unwrapped and gathered lines, their fields and those of grids, junk and
    excluded titles gone, fields in preferred sections, duplicates once, runs of consent text as one terms field, one
    signature, follow-ups under their questions (parent: the place of one), keys numbered in the order of that tree."""
    counted = K.stored(d, K.frequent(source, ["line"]), 1) if d.spark else ""
    tables = K.stored(d, G.table_lines(d, source, counted=counted))
    grid = f"SELECT doc_id, head_pos AS pos, 100 + col AS sub, key, title, coalesce({D.best_section(d, 'title', 'key')}, 'Medical History') AS section, 'checkbox' AS type, 'text' AS input_type, cast(n_options as int) AS n_options, options, 0 AS follow_up FROM ({G.questions(d, tables)}) g"
    read = fields(d, K.stored(d, O.prepared(d, source, counted)))
    known = getattr(read, "known", "")  # of all that follows, as it changes few titles and options
    about = lambda query: K.Known(query, known) if known else query
    raw = f"{read} UNION ALL {grid}"
    kept = f"SELECT * FROM ({raw}) f WHERE NOT {L.is_junk(d, 'key', 'title')} AND NOT {D.excluded(d, 'title')} AND NOT {D.is_document_title(d, 'title', 'type')}"
    if d.spark:
        gone = f"{L.is_junk(d, 'key', 'title')} OR {D.excluded(d, 'title')} OR {D.is_document_title(d, 'title', 'type')}"
        kept = f"SELECT * EXCEPT (gone) FROM ({K.ruled(d, about(raw), ['key', 'title', 'type'], {'gone': gone})}) f WHERE NOT gone"
    stage = lambda query: about(d.stage(query))
    kept = stage(consolidated(d, stage(voted_sections(d, stage(joined_continuations(d, stage(kept)))))))
    homed = f"SELECT doc_id, pos, sub, key, {D.clean_overflow(d, 'title')} AS title, {D.home_section(d, 'key', 'title', 'section')} AS section, type, input_type, n_options, options, follow_up FROM ({kept}) k"
    order = "OVER (PARTITION BY doc_id ORDER BY pos, sub)"
    reads = f"{L.is_consent_paragraph(d, 'title')} OR {L.is_procedure_text(d, 'title')} OR {L.is_risk_item(d, 'title')}"
    chosen = D.radio_or_checkbox(d, "title", "n_options", "false")
    if d.spark:
        homed = f"SELECT doc_id, pos, sub, key, clean AS title, coalesce(home, section) AS section, type, input_type, n_options, options, follow_up FROM ({K.ruled(d, about(at_home(d, kept)), ['title'], {'clean': D.clean_overflow(d, 'title')})}) k"
    once = semantic_duplicates(d, stage(homed))
    if d.spark:
        once = K.ruled(d, K.ruled(d, about(once), ["title"], {"reads": reads}), ["title", "n_options"], {"chosen": chosen})
        reads, chosen = "reads", "chosen"
    marked = f"SELECT *, (type = 'terms' OR {reads}) AS is_in FROM ({once}) h"
    runs = f"SELECT *, sum(CASE WHEN is_in AND was_in THEN 0 ELSE 1 END) {order} AS island FROM (SELECT *, coalesce(lag(is_in) {order}, false) AS was_in FROM ({marked}) m) w"
    in_run = "OVER (PARTITION BY doc_id, island ORDER BY pos, sub)"
    text = d.ordered_join("title", d.place("pos", "sub"), "</p><p>", over="OVER (PARTITION BY doc_id, island)")
    sized = f"SELECT *, row_number() {in_run} AS run_place, count(*) OVER (PARTITION BY doc_id, island) AS run_size, {text} AS run_text FROM ({runs}) r"
    terms = "(is_in AND run_size > 1)"
    final = f"CASE WHEN {terms} THEN 'terms' WHEN type IN ('block_signature', 'terms', 'date') OR n_options = 0 THEN type ELSE {chosen} END"
    joined = f"""SELECT doc_id, pos, sub, CASE WHEN {terms} THEN 'terms_and_conditions' ELSE key END AS key, CASE WHEN {terms} THEN 'Terms and Conditions' ELSE title END AS title, section, {final} AS type, input_type, n_options, options, follow_up,
    CASE WHEN {terms} OR type = 'terms' THEN concat('<p>', run_text, '</p>') ELSE '' END AS html FROM ({sized}) z WHERE NOT {terms} OR run_place = 1"""
    placed = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY {D.section_rank(d, 'section')}, pos, sub) AS place, pos, sub, key, title, section,
    type, CASE WHEN type = 'input' THEN input_type END AS input_type, n_options, options, follow_up, html FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, CASE WHEN type = 'block_signature' THEN 'sign' ELSE concat(cast(pos as varchar(20)), '.', cast(sub as varchar(20))) END ORDER BY pos, sub) AS s FROM ({joined}) d) r WHERE s = 1"""
    tree = P.nested(d, stage(placed), carry=CARRIED)
    return P.tree_keys(d, tree, ", ".join(["parent", "depth", "answer", *(c for c in CARRIED if c != "key")]))


def quoted(d: Dialect, x: str) -> str:
    """A text as JSON."""
    return f"""concat('"', replace(replace({x}, {d.lit(chr(92))}, {d.lit(chr(92) * 2)}), '"', {d.lit(chr(92) + '"')}), '"')"""


def records(d: Dialect, source: str) -> str:
    """Output records of converted fields: with the type's control as JSON (input type; options with values and whether
    several may be chosen; text of terms; hints and conditions as a template has them), asked `if` the question above it is answered so, and a second row for each
    follow-up in a question's own line."""
    value = lambda o: f"CASE WHEN lower({o}) IN ('yes', 'no') THEN {D.option_value(d, o)} ELSE {quoted(d, D.option_value(d, o))} END"
    one = lambda o: f"""concat('{{"name":', {quoted(d, o)}, ',"value":', {value(o)}, '}}')"""
    listed = f"concat('[', {d.join(d.map(d.filter(d.split('options', r'[|]'), 'o', chr(111) + ' <> ' + d.lit('')), 'o', one('o')), ',')}, ']')"
    multi = f"CASE WHEN multi <> '' THEN multi WHEN type = 'checkbox' OR {D.is_multi(d, 'title', 'n_options')} THEN 'true' ELSE 'false' END"
    control = d.case(
        [
            ("k = 1", """'{"input_type":"text","hint":"Please provide details"}'"""), ("type = 'input' AND hint <> ''", f"""concat('{{"input_type":"', coalesce(input_type, 'text'), '","hint":', {quoted(d, 'hint')}, '}}')"""), ("type IN ('radio', 'checkbox', 'dropdown')", f"""concat('{{"options":', {listed}, ',"multi":', {multi}, '}}')"""),
            ("type = 'terms'", f"""concat('{{"agree_text":"I have read and agree to the terms.","html_text":', {quoted(d, 'html')}, '}}')"""), ("type = 'date'", f"""concat('{{"input_type":"', {D.date_type(d, 'title')}, '"}}')"""),
            ("type = 'input'", """concat('{"input_type":"', coalesce(input_type, 'text'), '"}')"""),
        ], "'{}'",
    )
    copies = "sequence(0, follow_up)" if d.spark else "range(follow_up + 1)"
    named = f"SELECT *, {d.lookup('place', 'key', 'parent', 'OVER (PARTITION BY doc_id)')} AS parent_key FROM ({source}) n"
    rows = d.exploded(f"({named}) c", copies, "doc_id, place, key, title, section, type, input_type, n_options, options, html, parent_key, answer, hint, multi, needs", "again", pos="k")
    return f"""SELECT doc_id, place, k, CASE WHEN k = 1 THEN concat(key, '_explanation') ELSE key END AS key, CASE WHEN k = 1 THEN 'Please explain' ELSE title END AS title, section, CASE WHEN k = 1 THEN 'input' ELSE type END AS type,
  {control} AS control, CASE WHEN k = 1 THEN concat('[{{"key":', {quoted(d, "key")}, ',"value":"yes"}}]') WHEN parent_key IS NOT NULL THEN concat('[{{"key":', {quoted(d, "parent_key")}, ',"value":"', answer, '"}}]') WHEN needs <> '' THEN needs END AS condition FROM ({rows}) r"""


def section_matrix(d: Dialect, source: str) -> str:
    """How many fields each section has of each type, with zeros: the sections and types that there are, crossed."""
    counts = f"SELECT section, type, count(*) AS n FROM ({source}) f GROUP BY section, type"
    sections = " UNION ALL ".join(f"SELECT {d.lit(s)} AS section" for s in D.SECTION_RANK)
    types = " UNION ALL ".join(f"SELECT {d.lit(t)} AS type" for t in ("input", "date", "radio", "checkbox", "dropdown", "terms", "block_signature"))
    return f"SELECT s.section, t.type, coalesce(c.n, 0) AS n FROM ({sections}) s CROSS JOIN ({types}) t LEFT JOIN ({counts}) c ON s.section = c.section AND t.type = c.type"
