"""The engine's queries: each is one rule that both engines render, so the check runs the same question elsewhere."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as D
from ..functions import lines as L
from ..functions import questions as Q
from ..functions import similar as S
from ..functions import text as T
from ..functions.dialect import DUCK, SPARK, Dialect
from ..operators import catalog, classifier, dictionary, grids, joins, parser, quality, records, reports, splits, validate
from ..operators import lines as O
from ..operators.known import ruled, staged, stored, with_rules
from ..sources.forms import forms
from ..streaming import stream

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
SMALLEST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
#: Columns of fields beside the title, and of around() beside the line.
BESIDE = "doc_id|pos|sub|key|section|type|input_type|n_options|options|follow_up"
NEIGHBOURS = "doc_id|pos|before|before2|before3|following|total"
LONGEST = "spark.sql.codegen.hugeMethodLimit"
Make = Callable[[Dialect], str]


def form_lines(d: Dialect) -> str:
    return O.lines(d, f"({forms(d)}) forms")


def form_fields(d: Dialect) -> str:
    return records.fields(d, form_lines(d))


def placed_fields(d: Dialect) -> str:
    """Fields with a place in their document, in its order."""
    return f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, sub) AS place FROM ({form_fields(d)}) f"


def form_converted(d: Dialect) -> str:
    return records.converted(d, form_lines(d))


def form_tables(d: Dialect) -> str:
    return grids.table_lines(d, form_lines(d))


def form_best(d: Dialect) -> str:
    return catalog.best(d, form_fields(d))


def around(d: Dialect) -> str:
    return O.around(d, form_lines(d))


def per_line(**rules: Callable[[Dialect], str]) -> Make:
    """Expressions over the lines of forms and their neighbours. In Spark those over the line alone are computed once for
    each line that forms share."""

    def make(d: Dialect) -> str:
        made = {n: r(d) for n, r in rules.items()}
        if d.spark and not any(re.search(rf"\b({NEIGHBOURS})\b", e) for e in made.values()):
            return f"SELECT doc_id, pos, {', '.join(made)} FROM ({with_rules(d, form_lines(d), ['line'], [made])}) a"
        return f"SELECT doc_id, pos, {', '.join(f'{e} AS {n}' for n, e in made.items())} FROM ({around(d)}) a"

    return make


def per_field(**rules: Callable[[Dialect], str]) -> Make:
    """Expressions over fields. In Spark those over nothing but a field's title are computed once for each that is known."""

    def make(d: Dialect) -> str:
        made, source = {n: r(d) for n, r in rules.items()}, form_fields(d)
        if d.spark:
            alone = {n: e for n, e in made.items() if not re.search(rf"\b({BESIDE})\b", e)}
            source, made = ruled(d, source, ["title"], {f"f_{n}": e for n, e in alone.items()}), made | {n: f"f_{n}" for n in alone}
        return f"SELECT doc_id, pos, sub, {', '.join(f'{e} AS {n}' for n, e in made.items())} FROM ({source}) f"

    return make


def parts(array: Callable[[Dialect], str]) -> Make:
    """A splitter over the lines of forms that it makes anything of."""
    return lambda d: splits.generated(d, form_lines(d), array(d))


def over(operator: Callable[[Dialect, str], str], source: Make = form_lines) -> Make:
    return lambda d: operator(d, source(d))


def scored_attempts(d: Dialect) -> str:
    return quality.metrics(d, f"({quality.attempts(d)}) a", "doc_id, model, ord")


def document_quality(d: Dialect) -> str:
    return quality.metrics(d, "documents", "doc_id, lang, source")


def matched(d: Dialect) -> str:
    return catalog.merged(d, form_fields(d))


def once(d: Dialect, query: str, columns: str) -> str:
    """A query that a report reads several times, each time other columns: in Spark stored, as such reads share no plan."""
    return stored(d, f"SELECT {columns} FROM ({query}) o") if d.spark else d.stage(query)


def lone(d: Dialect, table: str, column: str, key: str) -> str:
    return f"SELECT {key} AS doc_id, 0 AS pos, 0 AS sub, {column} AS title FROM {table}"


RULES: dict[str, Make] = {
    # quality of texts and choice of extraction
    "quality_metrics": document_quality,
    "quality_by_lang": lambda d: f"SELECT lang, count(*) AS n, sum(chars) AS chars, cast(round(avg(score), 4) as double) AS mean_score, min(score) AS least, max(score) AS most FROM ({document_quality(d)}) q GROUP BY lang",
    "quality_histogram": lambda d: reports.histogram(d, document_quality(d), "score"),
    "best_extraction": lambda d: quality.best(d, scored_attempts(d)),
    "auto_extraction": lambda d: quality.auto(d, scored_attempts(d)),
    "extraction_comparison": lambda d: f"SELECT {', '.join(f'cast(round(avg(CASE WHEN model = {d.lit(m)} THEN score END), 4) as double) AS {m}' for m in quality.MODELS[:3])} FROM ({scored_attempts(d)}) a",
    "recommended_model": lambda d: f"SELECT page_id, {quality.recommended(d, 'url', 'length(html)')} AS model FROM pages",
    "scanned_documents": lambda d: f"SELECT doc_id, sum(length({d.trim('line')})) AS chars FROM ({O.lines(d, 'documents')}) l WHERE pos < 3 GROUP BY doc_id HAVING sum(length({d.trim('line')})) < 50",
    # text normalisation
    "restore_ligatures": per_line(t=lambda d: T.restore_ligatures(d, "line")),
    "normalize_whitespace": per_line(t=lambda d: T.normalize_whitespace(d, "line")),
    "close_labels": lambda d: S.close_pairs(d, "SELECT DISTINCT p_name AS text FROM part", "SELECT DISTINCT p_name AS label FROM part"),
    "corrected_words": lambda d: S.corrected_words(d, f"SELECT word FROM ({d.exploded('(' + form_lines(d) + ') l', d.split('line', '[^A-Za-z0-9]+'), 'doc_id', 'word', pos='k')}) w UNION ALL SELECT word FROM ({d.exploded('conversations', d.split('text', '[^A-Za-z0-9]+'), 'conv_id', 'word', pos='k')}) c"),
    "label_characters": per_line(t=lambda d: T.preprocess(d, "line", label=True)),
    "checkbox_artifacts": per_line(t=lambda d: T.clean_checkboxes(d, "line"), checked=lambda d: T.is_checked(d, "line")),
    "term_corrections": per_line(t=lambda d: T.fix_terms(d, "line")),
    "phone_corrections": per_line(t=lambda d: T.fix_phones(d, "line")),
    "date_corrections": per_line(t=lambda d: T.fix_dates(d, "line")),
    "glyph_normalize": per_line(t=lambda d: T.normalize_glyphs(d, "line")),
    "collapse_spaced": per_line(t=lambda d: T.collapse_spaced(d, "line")),
    "correction_counts": lambda d: f"SELECT doc_id, {', '.join(f'{e} AS {n}' for n, e in T.correction_counts(d, 'text').items())} FROM documents",
    "separate_blanks": per_line(t=lambda d: T.separate_blanks(d, "line")),
    "section_names": per_line(t=lambda d: T.section_name(d, "line")),
    "clean_titles": per_line(t=lambda d: T.clean_title(d, "line")),
    "option_text": per_line(t=lambda d: T.clean_option(d, "line"), name=lambda d: T.option_name(d, "line")),
    "slugify_keys": lambda d: f"SELECT p_partkey, {T.slugify(d, 'p_name')} AS slug, {T.repair_key(d, 'p_type')} AS repaired, {T.catalog_key(d, 'p_name')} AS catalog_key FROM part",
    "match_text": lambda d: f"SELECT doc_id, pos, {T.match_text(d, 'line')} AS t, {d.join(T.tokens(d, 'line'), ' ')} AS tokens FROM ({form_lines(d)}) l",
    "html_rows": lambda d: d.exploded("pages", T.html_rows(d, "html"), "page_id", "item"),
    "language_list": lambda d: d.exploded("(SELECT doc_id, concat(lang, ' , ,', source, ',', lang) AS langs FROM documents) l", T.language_list(d, "langs"), "doc_id", "item"),
    # predicates
    "headings": per_line(heading=lambda d: L.is_heading(d, "line"), category=lambda d: L.is_category_header(d, "line", "following")),
    "numbered_items": per_line(numbered=lambda d: L.is_numbered_item(d, "line"), orphan=lambda d: L.has_orphan_boxes(d, "line"), specify=lambda d: L.is_other_specify(d, "line")),
    "instructions": lambda d: f"SELECT doc_id, pos FROM ({O.lines(d, 'documents')}) l WHERE {L.is_instruction(d, 'line')}",
    "metadata": lambda d: f"SELECT doc_id, pos FROM ({O.lines(d, 'documents')}) l WHERE {L.is_metadata(d, 'line')}",
    "practice_locations": per_line(practice=lambda d: L.is_practice_location(d, "line", "before", "before2")),
    "consent_lines": per_line(paragraph=lambda d: L.is_consent_paragraph(d, "line"), heading=lambda d: L.is_consent_heading(d, "line"), terms=lambda d: L.should_be_terms(d, "line"), procedure=lambda d: L.is_procedure_text(d, "line")),
    "risk_lines": per_line(heading=lambda d: L.is_risk_heading(d, "line"), item=lambda d: L.is_risk_item(d, "line")),
    "signature_lines": per_line(signature=lambda d: L.is_signature(d, "line"), on_line=lambda d: L.is_signature_line(d, "line"), tabbed=lambda d: L.is_tabulated_signature(d, "line")),
    "weak_labels": per_line(label=lambda d: L.weak_label(d, "line")),
    "line_features": lambda d: f"SELECT doc_id, pos, {', '.join(f'{e} AS {n}' for n, e in L.features(d, 'line', chr(99) + 'oalesce(before, ' + d.lit('') + ')', 'coalesce(following, ' + d.lit('') + ')', 'pos', 'total').items())} FROM ({around(d)}) a",
    "information_sheets": over(O.information_sheets),
    "placed_headings": per_line(heading=lambda d: L.is_heading_in_place(d, "line", "following", "pos"), underline=lambda d: L.is_underline(d, "line"), split=lambda d: Q.should_split(d, "line")),
    "conditions": lambda d: f"SELECT doc_id, pos, sub, {Q.is_condition(d, 'title')} AS condition, {Q.is_conditions_field(d, 'type', 'options')} AS control, {L.is_option_dump(d, 'title')} AS dump FROM ({form_fields(d)}) f",
    "known_questions": per_line(sex=lambda d: Q.sex_gender(d, "line"), marital=lambda d: Q.marital_status(d, "line"), contact=lambda d: Q.preferred_contact(d, "line"), hear=lambda d: Q.is_hear_about(d, "line"), boxed=lambda d: Q.inline_box_text(d, "line"), bullet=lambda d: Q.bullet_option(d, "line")),
    # lines
    "document_lines": lambda d: O.lines(d, "documents"),
    "line_context": lambda d: f"SELECT conv_id, turn, lag(text) OVER w AS before, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "blocks": over(O.blocks),
    "block_summary": over(O.block_summary),
    "repeated_lines": lambda d: O.repeated(d, O.lines(d, "documents")),
    "scrubbed_lines": over(O.scrubbed),
    "soft_wraps": over(O.soft_wraps),
    "sections": over(O.sections),
    # splitters
    "labelled_parts": parts(lambda d: splits.labelled_parts(d, "line")),
    "known_label_parts": parts(lambda d: splits.known_label_parts(d, "line")),
    "question_parts": parts(lambda d: splits.question_parts(d, "line")),
    "slash_parts": parts(lambda d: splits.slash_parts(d, "line")),
    "blank_parts": parts(lambda d: splits.blank_parts(d, "line")),
    "subfields": parts(lambda d: splits.subfields(d, "line")),
    "colon_fields": parts(lambda d: splits.colon_fields(d, "line")),
    "box_options": parts(lambda d: splits.options(d, "line")),
    "yes_no_prompts": parts(lambda d: splits.yes_no_prompts(d, "line")),
    "tab_parts": parts(lambda d: f"CASE WHEN {L.is_tabulated_signature(d, 'line')} THEN {splits.tab_parts(d, 'line')} END"),
    "inline_choices": parts(lambda d: splits.inline_choices(d, "line")),
    "orphan_pairs": lambda d: d.exploded(f"({around(d)}) a", splits.orphan_pairs(d, "line", "following"), "doc_id, pos", "label", pos="sub"),
    "fill_in_labels": per_line(label=lambda d: splits.fill_in_label(d, "line", "before", "following"), inside=lambda d: splits.parenthetical_label(d, "line"), follow_up=lambda d: splits.yes_no_follow_up(d, "line")),
    "compound_fields": parts(lambda d: Q.compound_fields(d, "line")),
    "boxed_parts": parts(lambda d: Q.boxed_parts(d, "line")),
    "conditional_parts": parts(lambda d: Q.conditional_parts(d, "line")),
    "compound_labels": parts(lambda d: Q.compound_label(d, "line")),
    "spaced_labels": parts(lambda d: Q.spaced_labels(d, "line")),
    "id_and_ssn": parts(lambda d: Q.id_and_ssn(d, "line")),
    "gathered_options": over(O.gathered_options),
    "parsed_questions": over(parser.questions),
    "nested_fields": lambda d: parser.nested(d, placed_fields(d)),
    "nested_keys": lambda d: parser.tree_keys(d, parser.nested(d, placed_fields(d), carry={"key": "string", "type": "string", "title": "string"}), "title, depth"),
    "prepared_lines": over(O.prepared),
    "grid_tables": form_tables,
    "grid_boxes": over(grids.boxes, form_tables),
    "grid_columns": over(grids.columns, form_tables),
    "grid_cells": over(grids.cells, form_tables),
    "grid_text_only": over(grids.text_only, form_tables),
    "grid_questions": over(grids.questions, form_tables),
    "grid_conditions": over(grids.conditions),
    "grid_headers": per_line(is_header=lambda d: grids.is_header(d, "line")),
    "grid_chunks": lambda d: f"SELECT doc_id, pos, {d.join(grids.chunks(d, 'line', grids.n_columns(d, 'head')), '|')} AS cells FROM ({form_tables(d)}) t",
    # fields
    "fields": form_fields,
    "field_types": per_field(kind=lambda d: D.field_type(d, "title", "n_options"), control=lambda d: D.label_control(d, "title"), multi=lambda d: D.is_multi(d, "title", "n_options"), date=lambda d: D.date_type(d, "title")),
    "pii_typing": lambda d: f"SELECT doc_id, pos, {D.input_type(d, 'line')} AS input_type FROM ({form_lines(d)}) l WHERE {D.input_type(d, 'line')} <> 'text'",
    "option_values": lambda d: f"SELECT doc_id, pos, sub, part, {D.option_value(d, 'part')} AS value FROM ({splits.generated(d, form_lines(d), splits.options(d, 'line'))}) o",
    "date_keys": lambda d: f"SELECT doc_id, pos, {D.date_key(d, 'line', 'concat_ws(' + d.lit(' ') + ', before3, before2, before)', 'section')} AS key FROM (SELECT *, lag(line) {O.OVER} AS before, lag(line, 2) {O.OVER} AS before2, lag(line, 3) {O.OVER} AS before3 FROM ({O.sections(d, form_lines(d))}) s) a",
    "meanings": per_field(meaning=lambda d: D.meaning(d, "title"), in_section=lambda d: D.title_in_section(d, "title", "section"), filled=lambda d: D.filled(d, "title")),
    "guardian_keys": per_field(key=lambda d: D.guardian_key(d, "title", "key"), base=lambda d: D.strip_scope(d, "key"), signature=lambda d: D.signature_type(d, "title", "type"), valid=lambda d: L.is_valid_key(d, "key")),
    "numbered_keys": over(records.numbered_keys, form_fields),
    "semantic_duplicates": over(records.semantic_duplicates, form_fields),
    "preferred_section": over(records.in_preferred_section, form_fields),
    "most_informed": over(records.most_informed, form_fields),
    "consent_islands": over(records.consent_islands, form_fields),
    "procedure_islands": over(records.procedure_islands, form_fields),
    "risk_islands": over(records.risk_islands, form_fields),
    "event_islands": lambda d: "SELECT user_id, island, count(*) AS n FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM (SELECT *, CASE WHEN event_type IN ('signup', 'error') AND lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IN ('signup', 'error') THEN 0 ELSE 1 END AS starts FROM events) a) b GROUP BY user_id, island HAVING count(*) > 1",
    "inferred_sections": over(records.inferred_sections, form_fields),
    "voted_sections": over(records.voted_sections, form_fields),
    "consolidated": lambda d: records.consolidated(d, staged(d, form_fields(d))),
    "joined_continuations": over(records.joined_continuations, form_fields),
    "signature_blocks": over(parser.signature_blocks),
    "unique_titles": over(records.unique_titles, form_fields),
    "ordered_sections": over(records.ordered_sections, form_fields),
    "one_signature": over(records.one_signature, form_fields),
    "merged_options": over(records.merged_options, form_fields),
    "merged_conditions": over(records.merged_conditions, form_fields),
    "continued_options": over(records.continued_options, form_fields),
    "records": lambda d: records.records(d, d.stage(catalog.merged(d, stored(d, form_converted(d)) if d.spark else d.stage(form_converted(d)), None, records.CONVERTED))),
    "section_matrix": over(records.section_matrix, form_fields),
    "sorted_options": lambda d: f"SELECT doc_id, pos, sub, {d.join(d.distinct(d.split('options', '[|]')), '|')} AS options FROM ({form_fields(d)}) f WHERE n_options > 0",
    "labels_by_length": lambda d: f"SELECT doc_id, title, row_number() OVER (PARTITION BY doc_id ORDER BY length(title) DESC, title, pos, sub) AS place FROM ({form_fields(d)}) f",
    "sections_by_count": lambda d: f"SELECT doc_id, section, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, section) AS place FROM (SELECT doc_id, section, count(*) AS n FROM ({form_fields(d)}) f GROUP BY doc_id, section) c",
    "pages_by_url": lambda d: "SELECT page_id, url FROM pages ORDER BY url, page_id",
    "final_types": over(records.final_types, form_fields),
    "confidence": lambda d: records.scored(d, catalog.merged(d, form_fields(d), None, f"{catalog.FIELD_COLUMNS}, type, input_type")),
    "convert": over(records.converted),
    # catalogue
    "template_cascade": over(catalog.cascade, form_fields),
    "template_coverage": over(catalog.coverage, form_fields),
    "template_merge": matched,
    "template_fuzzy": lambda d: catalog.fuzzy(d, catalog.unknown(d, stored(d, form_best(d)))),
    "template_match": lambda d: catalog.match(d, stored(d, form_best(d))),
    "template_overlay": lambda d: catalog.merged(d, form_fields(d), None, f"{catalog.FIELD_COLUMNS}, type, input_type, n_options"),
    "template_smart": over(catalog.smart, form_fields),
    "template_log": over(catalog.match_log, form_fields),
    "template_keys_symmetric": lambda d: f"SELECT key, 'field' AS side FROM (SELECT key FROM ({form_fields(d)}) f EXCEPT SELECT t_key FROM ({catalog.templates(d)}) t) a UNION ALL SELECT key, 'template' AS side FROM (SELECT t_key AS key FROM ({catalog.templates(d)}) t EXCEPT SELECT key FROM ({form_fields(d)}) f) b",
    "template_keys_common": lambda d: f"SELECT key FROM ({form_fields(d)}) f INTERSECT SELECT t_key FROM ({catalog.templates(d)}) t",
    "names_union": lambda d: "SELECT lang AS name FROM documents UNION SELECT n_name FROM nation UNION SELECT r_name FROM region",
    "dictionary_violations": over(dictionary.violations, dictionary.from_parts),
    "dictionary_structure": over(dictionary.structure, dictionary.from_parts),
    "dictionary_aliases": lambda d: dictionary.expanded_aliases(d, f"SELECT {T.catalog_key(d, 'p_name')} AS phrase, min({T.catalog_key(d, 'p_type')}) AS key FROM part GROUP BY {T.catalog_key(d, 'p_name')} UNION ALL SELECT 'medical_history' AS phrase, 'own' AS key"),
    "dictionary_versions": lambda d: f"SELECT idx, {dictionary.next_version(d, 'version')} AS version FROM ({dictionary.from_parts(d)}) p",
    "template_unmatched": lambda d: f"SELECT key, title FROM ({matched(d)}) m WHERE NOT reused",
    "options_jaccard": lambda d: splits.alike_lists(d, f"SELECT DISTINCT options FROM ({form_fields(d)}) f WHERE n_options > 0"),
    # reports
    "stats": over(reports.stats, form_fields),
    "match_rates": over(reports.rates, matched),
    "label_rates": lambda d: reports.rates(d, "SELECT d.doc_id, l.quality = 1 AS reused FROM labels l JOIN documents d ON l.doc_id = d.doc_id"),
    "extremes": lambda d: reports.extremes(d, document_quality(d), "chars"),
    "subtotals": over(reports.subtotals, form_fields),
    "parity": lambda d: reports.parity(d, form_lines(d), matched(d)),
    "performance": lambda d: reports.performance(d, once(d, catalog.merged(d, form_fields(d), None, f"{catalog.FIELD_COLUMNS}, type, input_type, n_options"), "doc_id, type, section, key, reused"), reports.input_sizes(d, f"({forms(d)}) t"), catalog.templates(d)),
    "suggestions": lambda d: reports.suggestions(d, f"SELECT key, title FROM ({matched(d)}) m WHERE NOT reused"),
    "indicators": over(reports.indicators),
    "improvement": over(reports.improvement, form_best),
    "input_sizes": lambda d: reports.input_sizes(d, "documents"),
    "missing_patterns": lambda d: reports.missing_patterns(d, form_lines(d), form_fields(d)),
    "detailed": over(reports.detailed, matched),
    "text_coverage": lambda d: reports.text_coverage(d, form_lines(d), form_fields(d)),
    "subfields_missing": lambda d: reports.subfields_missing(d, form_lines(d), form_fields(d)),
    # validation
    "violations": over(validate.violations, form_fields),
    "structure_violations": lambda d: validate.structure(d, records.records(d, f"SELECT *, pos AS place, '' AS html, cast(NULL as bigint) AS parent, '' AS answer, '' AS hint, '' AS multi, '' AS needs FROM ({form_fields(d)}) f")),
    "option_violations": over(validate.option_quality, form_fields),
    "violation_summary": lambda d: validate.summary(d, validate.violations(d, form_fields(d))),
    "general_share": over(validate.general_share, form_fields),
    "orphan_orders": lambda d: validate.orphans(d, "orders", "o_orderkey", "lineitem", "l_orderkey"),
    "unlabelled_documents": lambda d: validate.orphans(d, "documents", "doc_id", "labels", "doc_id"),
    "event_maps": lambda d: f"SELECT user_id, {'cardinality(m)' if d.spark else 'cardinality(m)'} AS kinds, coalesce({'try_element_at(m, ' if d.spark else 'map_extract_value(m, '}'purchase'), 0) AS purchases FROM (SELECT user_id, map_from_entries({'collect_list(struct(event_type, n))' if d.spark else 'list(row(event_type, n))'}) AS m FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type) e GROUP BY user_id) u",
    "event_json": lambda d: f"SELECT event_id, {'from_json(props, ' + d.lit('k INT') + ').k' if d.spark else 'cast(json_extract_string(props, ' + d.lit('$.k') + ') as int)'} AS k, {'to_json(named_struct(' + d.lit('type') + ', event_type, ' + d.lit('user') + ', user_id))' if d.spark else 'cast(to_json(struct_pack(type := event_type, ' + chr(34) + 'user' + chr(34) + ' := user_id)) as varchar)'} AS made FROM events",
    "events_in_hour": lambda d: """SELECT p.event_id, count(e.event_id) AS n FROM (SELECT event_id, user_id, ts, h.hour AS hour FROM (SELECT event_id, user_id, ts, date_trunc('hour', ts) AS h0, date_trunc('hour', ts) - INTERVAL 1 HOUR AS h1 FROM events WHERE event_type = 'purchase') q
  CROSS JOIN LATERAL (SELECT q.h0 AS hour UNION ALL SELECT q.h1) h) p LEFT JOIN (SELECT event_id, user_id, ts, date_trunc('hour', ts) AS hour FROM events) e ON p.user_id = e.user_id AND p.hour = e.hour AND e.ts < p.ts AND e.ts >= p.ts - INTERVAL 1 HOUR GROUP BY p.event_id""",
    "last_before": lambda d: f"SELECT event_id, user_id, last_id FROM (SELECT event_id, user_id, event_type, {d.last('CASE WHEN event_type <> ' + d.lit('purchase') + ' THEN event_id END', 'PARTITION BY user_id ORDER BY ts, event_id')} AS last_id FROM events) w WHERE event_type = 'purchase'",
    "open_orders": lambda d: "SELECT o_custkey, count(*) AS n, max(open) AS most_open FROM (SELECT o_custkey, sum(step) OVER (PARTITION BY o_custkey ORDER BY moment, step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open FROM (SELECT o_custkey, o_orderdate AS moment, 1 AS step FROM orders UNION ALL SELECT o_custkey, o_orderdate + INTERVAL 60 DAY, -1 FROM orders) s) w GROUP BY o_custkey",
    "event_windows": lambda d: "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY date_trunc('hour', ts), event_type",
}


def views(spark: SparkSession, sf_dir: str, sql: str = "") -> None:
    """The tables that a query names, or all of them. Rules cost seconds a megabyte of lines, so small partitions are put
    together up to 64 KB only, where the session has Spark's default of a megabyte. Rules in one generated method of over 8000
    bytes are never compiled by the JVM, so such stages go without, where the session has the default of 65535."""
    if spark.conf.get(SMALLEST) == "1048576b":
        spark.conf.set(SMALLEST, "64k")
    if spark.conf.get(LONGEST) == "65535":
        spark.conf.set(LONGEST, "8000")
    for t in TABLES:
        if not sql or re.search(rf"\b{t}\b", sql):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views(spark, sf_dir)  # before the rule is rendered, as it may register stages
        return spark.sql(RULES[name](SPARK))

    query.__name__ = name
    return query


def line_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    samples = classifier.labelled_once(spark, around(SPARK))
    return classifier.predict(classifier.train(samples), samples)


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_windows as a stream over the same file."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.run_all(source, stream.event_windows).withColumn("start", F.col("start").cast("timestamp_ntz"))


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that a stream has closed."""
    return stream.appended(streamed_events(spark, sf_dir), stream.closed_sessions)[0].withColumn("start", F.col("start").cast("timestamp_ntz"))


def streamed_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the purchases within the hour after, by a join of the stream with itself."""
    return stream.appended(streamed_events(spark, sf_dir), stream.followed)[0]


def streamed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, with its customer's segment, of a stream joined with a table."""
    known = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    shape = lambda s: stream.with_known(stream.distinct_events(s), known, "user_id", "c_custkey").select("event_id", "user_id", "c_mktsegment")
    return stream.appended(streamed_events(spark, sf_dir), shape)[0]


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with the time that they are under way: a day for each line number."""
    lines_ = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines_.select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("start"), (F.col("l_shipdate") + F.expr("make_dt_interval(l_linenumber)")).alias("end"))


def overlapping_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each supplier how many pairs of shipments are under way at one time, and for how many hours in all."""
    given = shipments(spark, sf_dir)
    pairs = joins.overlap_join(given, given, ["l_suppkey"], seconds=8 * 86_400).filter("id < r_id")
    hours = (F.unix_micros(F.least("end", "r_end").cast("timestamp")) - F.unix_micros(F.greatest("start", "r_start").cast("timestamp"))) / F.lit(3_600_000_000)
    return pairs.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum(hours), 3).alias("hours"))


def status_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders by status with the priorities of the orders of that status: a few keys hold all rows, so they are
    joined in parts of 20,000 rows."""
    big = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_linestatus").alias("status"), "l_orderkey", "l_quantity")
    small = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_orderstatus").alias("status"), "o_orderpriority").agg(F.count("*").alias("orders"))
    joined = joins.skewed_join(big, small, ["status"], per=20_000)
    return joined.groupBy("status", "o_orderpriority").agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"), F.max("orders").alias("orders"))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.sessions(spark.read.parquet(f"{sf_dir}/events.parquet"))


SESSIONS_SQL = """SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts FROM events) a) b GROUP BY user_id, s"""


#: Queries whose check goes another way than their plan: all pairs, plain joins and batches.
OTHER_WAYS = {
    "close_labels": """WITH p AS (SELECT DISTINCT p_name AS x FROM part WHERE p_name <> '')
SELECT a.x AS text, b.x AS label, round(1 - (2 * levenshtein(a.x, b.x) - abs(length(a.x) - length(b.x))) / (length(a.x) + length(b.x))::DOUBLE, 6) AS alike FROM p a CROSS JOIN p b
WHERE levenshtein(a.x, b.x) <= 2 AND 1 - (2 * levenshtein(a.x, b.x) - abs(length(a.x) - length(b.x))) / (length(a.x) + length(b.x))::DOUBLE >= 0.85 AND (a.x = b.x OR (length(a.x) <= 40 AND length(b.x) <= 40))""",
    "streamed_sessions": f"SELECT user_id, start, n FROM ({SESSIONS_SQL.replace('count(*) AS n', 'count(*) AS n, max(ts) AS last')}) s WHERE last + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
    "streamed_followed": "SELECT a.user_id, a.event_id AS first_id, b.event_id AS then_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR",
    "streamed_segments": "SELECT DISTINCT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey",
    "overlapping_shipments": """WITH s AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS id, l_shipdate AS a, l_shipdate + to_days(l_linenumber) AS b FROM lineitem)
SELECT x.l_suppkey, count(*) AS n, round(sum((epoch_us(least(x.b, y.b)) - epoch_us(greatest(x.a, y.a))) / 3600000000.0), 3) AS hours FROM s x JOIN s y ON x.l_suppkey = y.l_suppkey AND x.id < y.id AND x.a < y.b AND y.a < x.b GROUP BY x.l_suppkey""",
    "status_shares": """SELECT status, o_orderpriority, count(*) AS lines, sum(l_quantity)::BIGINT AS quantity, max(orders) AS orders FROM (SELECT l_linestatus AS status, l_quantity FROM lineitem) l
JOIN (SELECT o_orderstatus AS status, o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL) o USING (status) GROUP BY ALL""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {f.__name__: f for f in (line_classifier, streamed_windows, event_sessions, streamed_sessions, streamed_followed, streamed_segments, overlapping_shipments, status_shares)}
    return {n: run(n) for n in RULES} | own


def oracle_sql() -> dict[str, str]:
    return {n: rule(DUCK) for n, rule in RULES.items()} | {"event_sessions": SESSIONS_SQL, "streamed_windows": RULES["event_windows"](DUCK)} | OTHER_WAYS
