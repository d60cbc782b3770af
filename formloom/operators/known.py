"""Rules computed once for each line that many documents share; Spark's way only, the check computes them row by row.

Forms of one kind repeat their lines, and a rule costs far more than a look into a small table. The most frequent lines
(all are counted) are stored with what the rules make of them and joined by broadcast. Any other line goes through the rules
themselves, so the table changes no result, whatever is in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..functions.dialect import Dialect
from ..sources.files import shared_folder

#: Bounds of a table of known values: rows and characters of a value, 4 MB of them at most.
MOST, LONGEST = 8192, 500


class Known(str):
    """A query that comes with one of the values that its rows often hold (`known`), so that rules over those columns are
    looked up without the rows being counted again."""

    known: str

    def __new__(cls, query: str, known: str) -> Known:
        made = super().__new__(cls, query)
        made.known = known
        return made


def staged(d: Dialect, query: str) -> str:
    """Dialect.stage() that keeps what a query is known to hold."""
    known = getattr(query, "known", "")
    return Known(d.stage(query), known) if known else d.stage(query)


def stored(d: Dialect, query: str, files: int | None = None) -> str:
    """The query as a table in the shared folder, for what reads it several times; in DuckDB the query itself."""
    if not d.spark:
        return query
    spark, path = SparkSession.active(), shared_folder(SparkSession.active(), "stored")
    df = spark.sql(query)
    (df.coalesce(files) if files else df).write.parquet(path)
    view = "stored_" + path.rpartition("-")[2]
    spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(view)
    return f"SELECT * FROM {view}"


def frequent(source: str, keys: Sequence[str]) -> str:
    """The values of some columns that are in more rows than one, the most frequent ones up to MOST."""
    given, short = ", ".join(keys), " AND ".join(f"length(cast({k} as string)) <= {LONGEST}" for k in keys)
    return f"SELECT {given} FROM (SELECT {given}, count(*) AS n_rows FROM ({source}) l WHERE {short} GROUP BY {given} HAVING count(*) > 1) c ORDER BY n_rows DESC, {given} LIMIT {MOST}"


def learn(d: Dialect, source: str, keys: Sequence[str], steps: Sequence[dict[str, str]], counted: str = "") -> str:
    """A stored table of frequent values: the keys and what the steps make of them, each a layer over those before. counted:
    a query of those values, if they are counted already."""
    return stored(d, layered(counted or frequent(source, keys), steps), 1)


def layered(query: str, steps: Sequence[dict[str, str]]) -> str:
    for made in steps:
        query = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in made.items())} FROM ({query}) q"
    return query


def look_up(source: str, table: str, keys: Sequence[str], steps: Sequence[dict[str, str]]) -> str:
    """source with what the steps make of the keys, from the table where it has them."""
    names = [n for made in steps for n in made]
    given = f"SELECT true AS k_hit, {', '.join(f'{c} AS k_{c}' for c in (*keys, *names))} FROM ({table}) t"
    query = f"SELECT /*+ BROADCAST(k) */ s.*, k.k_hit, {', '.join(f'k.k_{n}' for n in names)} FROM ({source}) s LEFT JOIN ({given}) k ON {' AND '.join(f's.{c} = k.k_{c}' for c in keys)}"
    for made in steps:
        query = f"SELECT *, {', '.join(f'CASE WHEN k_hit THEN k_{n} ELSE {e} END AS {n}' for n, e in made.items())} FROM ({query}) q"
    return f"SELECT * EXCEPT (k_hit, {', '.join(f'k_{n}' for n in names)}) FROM ({query}) q"


def ruled(d: Dialect, source: str, keys: Sequence[str], made: dict[str, str]) -> str:
    """source with what rules make of its keys, in Spark from a small table for the values that it is known to hold."""
    known = getattr(source, "known", "")
    if not known or not made:
        return layered(source, [made] if made else [])
    return Known(look_up(source, stored(d, layered(f"SELECT DISTINCT {', '.join(keys)} FROM ({known}) v", [made]), 1), keys, [made]), known)


def with_rules(d: Dialect, source: str, keys: Sequence[str], steps: Sequence[dict[str, str]], counted: str = "") -> str:
    """source, which is counted once before it is read, with what the steps make of its keys."""
    return look_up(source, learn(d, source, keys, steps, counted), keys, steps)
