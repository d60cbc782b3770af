"""Whole jobs from files to records and reports. Each step's rows are written once and read by all that follow, so no later
plan repeats an earlier one and lost executors lose nothing that was written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import SPARK
from ..operators import catalog, lines, quality, records, reports, validate
from ..operators import dictionary as dictionaries
from ..sources import files


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def viewed(df: DataFrame) -> str:
    """A query of df, by a view of its own name: jobs in one session don't meet."""
    view = f"_job_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    return f"SELECT * FROM {view}"


def convert_texts(spark: SparkSession, texts: DataFrame, out: str, dictionary: str | None = None) -> DataFrame:
    """Texts (doc_id, text) to folders below `out`: converted fields matched with the catalogue and stats (Parquet), records
    (JSON, with control, options and conditions), and the reports rates, performance, suggestions, violations, skipped (CSV). Returns the
    rates, one row. doc_id may be of any type, such as a path.

    dictionary: a JSON file of templates and aliases, see files.read_catalog(); without one the fixed catalogue is used.
    Documents without text or with a marker of a failed extraction have no records but a row of `skipped`; of none there are
    empty reports.
    """
    usable = files.usable("text")
    files.write_report(texts.filter(~F.coalesce(usable, F.lit(False))).select("doc_id", F.when(F.coalesce(F.trim("text"), F.lit("")) == "", "no text").otherwise(F.substring("text", 1, 40)).alias("reason")), f"{out}/skipped")
    given = viewed(saved(texts.select("doc_id", "text").filter(usable), f"{out}/texts"))
    own = catalog.register(*files.read_catalog(spark, dictionary)) if dictionary else None
    converted = viewed(saved(spark.sql(records.converted(SPARK, lines.lines(SPARK, f"({given})"))), f"{out}/converted"))
    exact = viewed(saved(spark.sql(catalog.best(SPARK, converted, own, records.CONVERTED)), f"{out}/exact"))
    matched = viewed(saved(spark.sql(catalog.overlaid(SPARK, catalog.match(SPARK, exact, own, records.CONVERTED), own, records.CONVERTED)), f"{out}/matched"))
    files.write_records(spark.sql(records.records(SPARK, matched)), f"{out}/records")
    stats = spark.sql(reports.stats(SPARK, matched)).join(spark.sql(reports.input_sizes(SPARK, given)), "doc_id")
    stats.join(spark.sql(reports.detailed(SPARK, matched)).select("doc_id", "matched", "rate", "unmatched"), "doc_id").write.mode("overwrite").parquet(f"{out}/stats")
    rates = saved(spark.sql(reports.rates(SPARK, matched)), f"{out}/rates_table")
    files.write_report(rates, f"{out}/rates")
    files.write_report(spark.sql(reports.performance(SPARK, matched, reports.input_sizes(SPARK, given), catalog.templates(SPARK, own))).orderBy("part", F.desc("value"), "label"), f"{out}/performance")
    files.write_report(spark.sql(reports.suggestions(SPARK, f"SELECT key, title FROM ({matched}) m WHERE NOT reused")), f"{out}/suggestions")
    files.write_report(spark.sql(validate.summary(SPARK, validate.violations(SPARK, converted))), f"{out}/violations")
    return rates


def check_dictionary(spark: SparkSession, path: str, out: str) -> DataFrame:
    """A JSON dictionary checked: folders `violations` (of fields), `problems` (of the file) and `structure` (CSV) below out.
    Returns category, idx, key, rule, severity of all, those of the file with the category `_file`."""
    fields_, problems = files.read_dictionary(spark, path)
    view = viewed(saved(fields_, f"{out}/fields"))
    problems = saved(problems, f"{out}/problems_table")
    found = spark.sql(dictionaries.violations(SPARK, view)).unionByName(problems.select(F.lit("_file").alias("category"), F.lit(None).cast("int").alias("idx"), F.col("what").alias("key"), "rule", "severity"))
    found = saved(found.distinct(), f"{out}/violations_table")  # a field with several conditions has a row for each
    files.write_report(found, f"{out}/violations")
    files.write_report(spark.sql(dictionaries.structure(SPARK, f"SELECT DISTINCT category, idx, key FROM ({view}) v")), f"{out}/structure")
    return found


def expand_dictionary(spark: SparkSession, path: str, out: str) -> DataFrame:
    """A JSON dictionary with the conditions template, the aliases it lacks and the next version, written below out as text.
    The given file stays as it is."""
    made = files.expanded_dictionary(spark, path, dictionaries.NEW_ALIASES, "medical_conditions", dictionaries.conditions_template(), lambda c: dictionaries.next_version(SPARK, c))
    made.coalesce(1).write.mode("overwrite").text(out)
    return spark.read.text(out, wholetext=True)


def extract_folder(spark: SparkSession, source: str, out: str, mode: str = "auto", extractors: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """PDF and DOCX files below a folder to texts: doc_id (the path), model, score, text.

    mode: the name of a model; `recommend`, each file by the model for its kind; `all`, one row for each file and model; or `auto`: models are tried in order, each only on
    the files that none before read well enough, and the best attempt of each file stays. Attempts are kept below `out`.
    """
    known = extractors or files.EXTRACTORS
    if mode == "recommend":
        return recommend(spark, source, out, known)
    models = [m for m in (*quality.MODELS, *sorted(set(known) - set(quality.MODELS))) if m in known] if mode in ("auto", "all") else [mode]
    left, done = files.read_binaries(spark, source), None
    for i, model in enumerate(models):
        tried = files.extract(left, model, known).select(F.col("path").alias("doc_id"), "model", F.lit(i).alias("ord"), "text", "success", "error")
        tried = saved(tried, f"{out}/attempts/{i}")
        measures = spark.sql(quality.metrics(SPARK, f"({viewed(tried)}) a", "doc_id, model, ord")).select("doc_id", "chars", "score")
        scored = saved(tried.join(measures, "doc_id"), f"{out}/scored/{i}")
        done = scored if done is None else done.unionByName(scored)
        if mode == "auto":
            good = scored.filter(F.col("score") >= (quality.ACCEPT if i == 0 else quality.ENOUGH))
            left = left.join(good.select(F.col("doc_id").alias("path")), "path", "left_anti")
    if mode == "auto":
        chosen = spark.sql(quality.auto(SPARK, viewed(done))).select("doc_id", "model")
        done = done.join(chosen, ["doc_id", "model"])
    return saved(done.select("doc_id", "model", "score", "text", "success", "error"), f"{out}/extracted")


def recommend(spark: SparkSession, source: str, out: str, known: dict[str, Callable[[bytes], str]]) -> DataFrame:
    """Each file by the model recommended for it: a cheap reading decides whether it is scanned."""
    found = files.read_binaries(spark, source)
    first = saved(files.extract(found, "pdfplumber", known).select("path", F.length("text").alias("chars")), f"{out}/first")
    view = viewed(first)
    chosen = saved(spark.sql(f"SELECT path, {quality.recommended(SPARK, 'path', 'chars')} AS chosen FROM ({view}) v"), f"{out}/chosen")
    parts = None
    for model in [m for m in quality.MODELS if m in known]:
        one = files.extract(found.join(chosen.filter(F.col("chosen") == model).select("path"), "path", "left_semi"), model, known)
        parts = one if parts is None else parts.unionByName(one)
    tried = saved(parts.select(F.col("path").alias("doc_id"), "model", F.lit(0).alias("ord"), "text", "success", "error"), f"{out}/attempts/0")
    score = spark.sql(quality.metrics(SPARK, f"({viewed(tried)}) a", "doc_id, model, ord")).select("doc_id", "score")
    return saved(tried.join(score, "doc_id").select("doc_id", "model", "score", "text", "success", "error"), f"{out}/extracted")


def convert_folder(spark: SparkSession, source: str, out: str, dictionary: str | None = None) -> DataFrame:
    """The .txt files below a folder through convert_texts(); a document's id is its path."""
    return convert_texts(spark, files.read_texts(spark, source).withColumnRenamed("path", "doc_id"), out, dictionary)


def run_all(
    spark: SparkSession, source: str, out: str, mode: str = "auto", extractors: dict[str, Callable[[bytes], str]] | None = None, dictionary: str | None = None
) -> DataFrame:
    """From PDF and DOCX files to records and reports."""
    return convert_texts(spark, extract_folder(spark, source, f"{out}/extraction", mode, extractors), out, dictionary)
