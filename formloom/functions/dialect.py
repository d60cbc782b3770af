"""SQL of two dialects from one definition: Spark, which runs it, and DuckDB, which checks it.

Every function of the engine is a rule that renders an expression for a dialect. `column()` makes a Spark column of a
rule, so rules compose with the DataFrame API; nothing here needs a Python worker. Patterns keep to what Java and RE2
read alike: no look-around, ASCII classes, no backslash-w on text beyond ASCII.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class Dialect:
    """Rendering of the calls that the two engines name differently."""

    def __init__(self, name: str):
        self.name, self.spark = name, name == "spark"

    def lit(self, s: str) -> str:
        if not self.spark:
            parts = s.split("\n")
            return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts) if len(parts) > 1 else "'" + s.replace("'", "''") + "'"
        if "\n" in s:
            return "concat_ws('\\n', " + ", ".join(self.lit(p) for p in s.split("\n")) + ")"
        quote = '"' if "'" in s else "'"
        if quote in s:
            raise ValueError(f"both quotes in {s!r}")
        return f"r{quote}{s}{quote}"

    def code(self, c: str) -> str:
        """A control character."""
        return f"{'char' if self.spark else 'chr'}({ord(c)})"

    def array(self, items: Sequence[str]) -> str:
        inner = ", ".join(map(self.lit, items))
        return f"array({inner})" if self.spark else f"[{inner}]"

    def sub(self, x: str, pattern: str, to: str, ci: bool = False) -> str:
        if self.spark:
            return f"regexp_replace({x}, {self.lit('(?i)' * ci + pattern)}, {self.lit(re.sub(r'[$](?![0-9])', '', to))})"
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(re.sub(r'[$]([0-9])', r'\\\1', to))}, '{'gi' if ci else 'g'}')"

    def has(self, x: str, pattern: str, ci: bool = False) -> str:
        return f"regexp_like({x}, {self.lit('(?i)' * ci + pattern)})" if self.spark else f"regexp_matches({x}, {self.lit('(?i)' * ci + pattern)})"

    def any_match(self, x: str, patterns: Sequence[str], ci: bool = False) -> str:
        """Whether any of the patterns is in x, in one search: most of a search's cost on a short line is its beginning."""
        return self.has(x, "|".join(f"({p})" for p in patterns), ci)

    def count(self, x: str, pattern: str, ci: bool = False) -> str:
        if len(pattern) == 1 and pattern not in r".^$*+?()[]{}|\\":
            return f"(length({x}) - length(replace({x}, {self.lit(pattern)}, '')))"
        p = self.lit("(?i)" * ci + pattern)
        return f"regexp_count({x}, {p})" if self.spark else f"len(regexp_extract_all({x}, {p}))"

    def chars_of(self, x: str, kind: str) -> str:
        """How many characters are of a class, such as `\\p{L}`: what is left once the runs of all others are gone, which
        costs a match for each run where count() has one for each character."""
        return f"length({self.sub(x, f'[^{kind}]+', '')})"

    def all(self, x: str, pattern: str, group: int = 0, ci: bool = False) -> str:
        return f"regexp_extract_all({x}, {self.lit('(?i)' * ci + pattern)}, {group})"

    def first(self, x: str, pattern: str, group: int = 0, ci: bool = False) -> str:
        return f"regexp_extract({x}, {self.lit('(?i)' * ci + pattern)}, {group})"

    def split(self, x: str, pattern: str) -> str:
        return f"split({x}, {self.lit(pattern)})" if self.spark else f"string_split_regex({x}, {self.lit(pattern)})"

    def size(self, a: str) -> str:
        return f"size({a})" if self.spark else f"len({a})"

    def item(self, a: str, i: str | int) -> str:
        """From 1; null beyond the end."""
        return f"try_element_at({a}, cast({i} as int))" if self.spark else f"list_extract({a}, {i})"

    def slice(self, a: str, start: int, n: str | int) -> str:
        return f"slice({a}, {start}, {n})" if self.spark else f"list_slice({a}, {start}, {start} + ({n}) - 1)"

    def map(self, a: str, v: str, e: str) -> str:
        return f"transform({a}, {v} -> {e})" if self.spark else f"list_transform({a}, lambda {v}: {e})"

    def filter(self, a: str, v: str, e: str) -> str:
        return f"filter({a}, {v} -> {e})" if self.spark else f"list_filter({a}, lambda {v}: {e})"

    def distinct(self, a: str) -> str:
        """Distinct items in order, so both engines agree."""
        return f"array_sort(array_distinct({a}))" if self.spark else f"list_sort(list_distinct({a}))"

    def common(self, a: str, b: str) -> str:
        return f"array_intersect({a}, {b})" if self.spark else f"list_intersect({a}, {b})"

    def join(self, a: str, sep: str) -> str:
        return f"array_join({a}, {self.lit(sep)})" if self.spark else f"array_to_string({a}, {self.lit(sep)})"

    def starts(self, x: str, s: str) -> str:
        return f"startswith({x}, {self.lit(s)})" if self.spark else f"starts_with({x}, {self.lit(s)})"

    def ends(self, x: str, s: str) -> str:
        return f"endswith({x}, {self.lit(s)})" if self.spark else f"ends_with({x}, {self.lit(s)})"

    def contains(self, x: str, s: str) -> str:
        return f"contains({x}, {self.lit(s)})"

    def any_of(self, x: str, words: Sequence[str]) -> str:
        """Whether x contains any of the words."""
        return "(" + " OR ".join(self.contains(x, w) for w in words) + ")"

    def hits(self, x: str, words: Sequence[str]) -> str:
        """How many of the words x contains."""
        return "(" + " + ".join(f"cast({self.contains(x, w)} as int)" for w in words) + ")"

    def matches(self, x: str, patterns: Sequence[str], ci: bool = False) -> str:
        """How many of the patterns are in x."""
        return "(" + " + ".join(f"cast({self.has(x, p, ci)} as int)" for p in patterns) + ")"

    def trim(self, x: str) -> str:
        return f"btrim({x}, ' \\t\\r\\n')" if self.spark else f"trim({x}, ' ' || chr(9) || chr(13) || chr(10))"

    def squeeze(self, x: str) -> str:
        """One blank for each run of white space, none at the ends."""
        return self.trim(self.sub(x, r"[ \t\r\n]+", " "))

    def words(self, x: str) -> str:
        """Number of words."""
        return self.count(x, r"[^ \t\r\n]+")

    def title(self, x: str) -> str:
        """Each word with a capital."""
        return f"initcap({x})" if self.spark else self.join(self.map(f"string_split({x}, ' ')", "w", "upper(w[1:1]) || lower(w[2:])"), " ")

    def exploded(self, source: str, array: str, columns: str, name: str, pos: str = "pos") -> str:
        """A query: a row for each item of an array expression of `source`, numbered from 0."""
        if self.spark:
            return f"SELECT {columns}, cast({pos} as bigint) AS {pos}, {name} FROM {source} LATERAL VIEW posexplode({array}) AS {pos}, {name}"
        return f"SELECT {columns}, unnest(range(len({array}))) AS {pos}, unnest({array}) AS {name} FROM {source}"

    def ordered_join(self, x: str, order: str, sep: str, over: str = "") -> str:
        """Aggregate, or over a window: the values of x that aren't null, in an order, as one text."""
        if self.spark:
            return f"array_join(transform(array_sort(collect_list(struct({order} AS o, {x} AS v)) {over}), e -> e.v), {self.lit(sep)})"
        return f"coalesce(string_agg({x}, {self.lit(sep)} ORDER BY {order}) {over}, '')"

    def stage(self, query: str) -> str:
        """The query as a view of its own, analysed by itself: Spark gives up on a text that is nested too deeply. Nothing is
        computed or stored, and the plan of what reads it is optimised as a whole."""
        if not self.spark:
            return query
        spark, view = SparkSession.active(), f"stage_{zlib.crc32(query.encode()):08x}"
        spark.sql(query).createOrReplaceTempView(view)
        return f"SELECT * FROM {view}"

    def lookup(self, name: str, value: str, wanted: str, over: str) -> str:
        """Over a window: the value of the row whose name is the wanted one; null without one. A window's rows are few."""
        if self.spark:  # most rows want none
            return f"CASE WHEN {wanted} IS NOT NULL THEN try_element_at(filter(collect_list(struct({name} AS n, {value} AS v)) {over}, e -> e.n = {wanted}), 1).v END"
        return f"list_filter(list({{'n': {name}, 'v': {value}}}) {over}, lambda e: e.n = {wanted})[1].v"

    def place(self, *columns: str) -> str:
        """Several columns as one value that orders as they do."""
        return f"struct({', '.join(columns)})" if self.spark else f"row({', '.join(columns)})"

    def count_if(self, cond: str) -> str:
        return f"coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0)"

    def let(self, value: str, name: str, body: str) -> str:
        """body, in which `name` is a value computed once: keeps rules that use a value often from growing with each use."""
        if self.spark:
            return f"element_at(transform(array({value}), {name} -> {body}), 1)"
        return f"list_extract(list_transform([{value}], lambda {name}: {body}), 1)"

    def last(self, x: str, over: str) -> str:
        """The last value of x that isn't null, up to the row, in a window."""
        frame = f"OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return f"last_value({x}) IGNORE NULLS {frame}" if self.spark else f"last_value({x} IGNORE NULLS) {frame}"

    def fold(
        self, source: str, order: Sequence[str], columns: dict[str, str], state: dict[str, tuple[str, str, str]], out: dict[str, str], emits: Sequence[tuple[str, dict[str, str]]], end: dict[str, str],
        key: str = "doc_id",
    ) -> str:
        """A query: for each key the rows that one pass over its rows, in an order, emits.

        columns: what a step sees of a row `x`, with types. state: of each value of the state `s` the type, what it begins
        with and what a step makes of it. out: the columns that are emitted, with types; emits: what a step may emit, each a
        condition and the columns, which refer to the state before the step and to the row. end: the columns of a last row,
        after all others, at which what is left is emitted.

        Spark folds an array of the key's rows, which one task holds, as it does for a window; DuckDB steps all keys at once
        in a recursive query, so the check takes another way through.
        """
        made = {n: f"cast({e} as {t})" for n, (t, _, e) in state.items()}
        begun = {n: f"cast({e} as {t})" for n, (t, e, _) in state.items()}
        told = [(c, {n: f"cast({e[n]} as {t})" for n, t in out.items()}) for c, e in emits]
        last = {c: f"cast({end[c]} as {t})" for c, t in columns.items()}
        if self.spark:
            pack = lambda d: "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in d.items()) + ")"
            given = pack({f"o{i}": o for i, o in enumerate(order)} | {c: f"cast({c} as {t})" for c, t in columns.items()})
            rows = f"concat(transform(array_sort(collect_list({given})), r -> {pack({c: f'r.{c}' for c in columns})}), array({pack(last)}))"
            none = f"cast(array() as array<struct<{', '.join(f'{n}:{t}' for n, t in out.items())}>>)"
            emitted = f"concat(s.emitted, {', '.join(f'CASE WHEN {c} THEN array({pack(e)}) ELSE {none} END' for c, e in told)})"
            fold = f"aggregate({rows}, {pack(begun | {'emitted': none})}, (s, x) -> {pack(made | {'emitted': emitted})}, s -> s.emitted)"
            return f"SELECT {key}, {', '.join(f'f.{n}' for n in out)} FROM (SELECT {key}, explode(f) AS f FROM (SELECT {key}, {fold} AS f FROM ({source}) q GROUP BY {key}) g) e"
        name = f"fold_{zlib.crc32(source.encode()):08x}"
        of = lambda d: ", ".join(f"{e} AS {n}" for n, e in d.items())
        parts = [{f"e{i}": c} | {f"e{i}_{n}": v for n, v in e.items()} for i, (c, e) in enumerate(told)]
        blank = [{f"e{i}": "false"} | {f"e{i}_{n}": f"cast(NULL as {t})" for n, t in out.items()} for i in range(len(told))]
        given = of({c: f"cast({c} as {t})" for c, t in columns.items()})
        return f"""SELECT * FROM (WITH RECURSIVE {name}_given AS MATERIALIZED (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY {", ".join(order)}) AS fold_at, {given} FROM ({source}) q),
  {name}_rows AS MATERIALIZED (SELECT * FROM {name}_given UNION ALL SELECT {key}, max(fold_at) + 1 AS fold_at, {of(last)} FROM {name}_given GROUP BY {key}),
  {name} AS (SELECT DISTINCT {key}, cast(0 as bigint) AS fold_at, {of(begun)}, {", ".join(map(of, blank))} FROM {name}_rows
    UNION ALL SELECT x.{key}, x.fold_at, {of(made)}, {", ".join(map(of, parts))} FROM {name} s JOIN {name}_rows x ON s.{key} = x.{key} AND x.fold_at = s.fold_at + 1)
  {" UNION ALL ".join(f"SELECT {key}, {', '.join(f'e{i}_{n} AS {n}' for n in out)} FROM {name} WHERE e{i}" for i in range(len(told)))}) folded"""

    def case(self, rules: Sequence[tuple[str, str]], other: str) -> str:
        """The value of the first rule that holds, in their order."""
        return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {other} END"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")

Rule = Callable[..., str]


def column(rule: Rule, *names: str, **options: object) -> Column:
    """A rule over columns of a DataFrame, as a Spark column."""
    return F.expr(rule(SPARK, *names, **options))
