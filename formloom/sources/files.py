"""Reading documents from files and writing records: text, binary with optional extractors, catalogues, JSON, CSV."""

from __future__ import annotations

import importlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that extraction leaves where there is none.
MARKERS = ("[NO TEXT LAYER]", "[OCR NOT AVAILABLE]")
EXTRACTED = "path string, model string, text string, success boolean, error string"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of each file below a folder; a file that isn't UTF-8 is read as Latin-1."""
    text = F.col("content").cast("string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return files.select("path", F.when(F.is_valid_utf8(text), text).otherwise(F.decode("content", "ISO-8859-1")).alias("text")).filter(usable("text"))


def usable(column: str) -> F.Column:
    """Whether there is text to work on: not blank, and no marker of a failed extraction."""
    return (F.trim(column) != "") & ~F.coalesce(F.col(column).rlike("^(" + "|".join(m.replace("[", r"\[").replace("]", r"\]") for m in MARKERS) + ")"), F.lit(False))


def read_binaries(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the PDF and DOCX files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{pdf,docx}").load(path).select("path", "content")


def _plumber(content: bytes) -> str:
    import io

    with importlib.import_module("pdfplumber").open(io.BytesIO(content)) as pdf:
        return "\n".join(page.extract_text() or "" for page in pdf.pages)


#: Strategies of the general partitioner in their order: the next is tried when one fails or finds no text.
STRATEGIES = ("hi_res", "fast", "ocr_only")


def _partition(content: bytes, strategies: tuple[str, ...] = STRATEGIES, retries: int = 2) -> str:
    """Text of a file's elements, tables row by row; each strategy is tried again before the next one."""
    import io

    partition, last = importlib.import_module("unstructured.partition.auto").partition, None
    for strategy in strategies:
        for _ in range(retries):
            try:
                text = "\n\n".join(element_text(e) for e in partition(file=io.BytesIO(content), strategy=strategy))
            except Exception as e:  # noqa: BLE001  the next attempt may do
                last = e
                continue
            if text.strip():
                return text
            break
    if last:
        raise last
    return ""


def element_text(element: object) -> str:
    """Text of an extracted element; of a table with HTML its rows, cells parted by bars."""
    import re

    html = getattr(getattr(element, "metadata", None), "text_as_html", None)
    if not html:
        return str(element)
    rows = re.findall(r"<tr[^>]*>(.*?)</tr>", html, re.S)
    clean = lambda c: " ".join(re.sub(r"<[^>]*>", " ", c).split())
    return "\n".join(" | ".join(map(clean, re.findall(r"<t[hd][^>]*>(.*?)</t[hd]>", r, re.S))) for r in rows) or str(element)


def _images(content: bytes) -> list:
    return importlib.import_module("pdf2image").convert_from_bytes(content)


def _tesseract(content: bytes) -> str:
    read = importlib.import_module("pytesseract").image_to_string
    return "\n".join(read(page) for page in _images(content))


def _easyocr(content: bytes) -> str:
    import numpy as np

    reader = importlib.import_module("easyocr").Reader(["en"])
    return "\n".join("\n".join(reader.readtext(np.asarray(page), detail=0)) for page in _images(content))


def _doctr(content: bytes) -> str:
    model = importlib.import_module("doctr.models").ocr_predictor(pretrained=True)
    return model(importlib.import_module("doctr.io").DocumentFile.from_pdf(content)).render()


def _ocrmypdf(content: bytes) -> str:
    """A text layer by OCR in a file of the task's own, read as any PDF is."""
    import io

    out = io.BytesIO()
    importlib.import_module("ocrmypdf").ocr(io.BytesIO(content), out, force_ocr=True, progress_bar=False)
    return _plumber(out.getvalue())


#: Extractors by model. Their libraries are optional: without one, the row says so.
EXTRACTORS: dict[str, Callable[[bytes], str]] = {
    "pdfplumber": _plumber, "unstructured": _partition, "tesseract": _tesseract, "easyocr": _easyocr, "doctr": _doctr, "ocrmypdf": _ocrmypdf,
}


def extract(files: DataFrame, model: str, extractors: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """One attempt for each file: path, model, text, success, error. Errors are rows, never failures. Files come in batches
    as Arrow bounds them by bytes, and one is open at a time."""
    known = extractors or EXTRACTORS

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    rows.append((path, model, known[model](content), True, None))
                except KeyError:
                    rows.append((path, model, "", False, f"Unknown model: {model}"))
                except Exception as e:  # noqa: BLE001  an optional library or a broken file
                    rows.append((path, model, "", False, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "model", "text", "success", "error"])

    return files.mapInPandas(run, EXTRACTED)


def read_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Templates (key, title, section, type, input_type, hint, multi, condition, options, ord) and aliases (alias, key) of a
    JSON dictionary of lists of fields. `ord` goes by the lists' order and then by the place, so the first of equal keys is
    the same in every run; a condition is the JSON of the field's `if`."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("list", "m")).select("list", F.col("m.key").alias("name"), F.col("m.value").alias("body"))
    item = "array<struct<key:string,title:string,section:string,type:string,control:struct<input_type:string,hint:string,multi:boolean,options:array<struct<name:string>>>,`if`:array<struct<key:string,value:string>>>>"
    listed = raw.filter(~F.col("name").startswith("_") & (F.col("name") != "aliases")).select("name", "list", F.posexplode(F.from_json("body", item)).alias("at", "f"))
    fields = listed.select(
        "f.key", "f.title", "f.section", "f.type", "f.control.input_type", "f.control.hint", F.col("f.control.multi").cast("string").alias("multi"), F.when(F.size("f.if") > 0, F.to_json("f.if")).alias("condition"),
        F.coalesce(F.array_join("f.control.options.name", "|"), F.lit("")).alias("options"), "name", (F.col("list").cast("long") * 1_000_000_000 + F.col("at")).alias("ord"),
    )
    aliases = raw.filter("name = 'aliases'").select(F.explode(F.from_json("body", "map<string,string>")).alias("alias", "key"))
    return fields.filter("key is not null"), aliases


def read_dictionary(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The fields of a JSON dictionary for dictionary.violations() (category, idx, key, type, input_type, options, option_values,
    if_key, version; a row for each condition of a field), and what is wrong with the file as a whole (rule, severity, what)."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    meta = F.from_json(F.col("m")["_meta"], "map<string,string>")
    names = F.filter(F.map_keys("m"), lambda k: ~k.startswith("_") & (k != "aliases"))
    no_lists = F.filter(names, lambda k: ~F.ltrim(F.element_at("m", k)).startswith("["))
    say = lambda rule, severity, what: F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), what.alias("what"))
    lacks = [F.when(F.col("m")["_meta"].isNotNull() & F.coalesce(meta[k], F.lit("")).eqNullSafe(""), say("meta_field_missing", "error", F.lit(k))) for k in ("name", "version")]
    first = [
        F.when(F.col("m").isNull() | (F.size("m") == 0), say("empty_or_no_json", "error", F.lit(path))), F.when(F.col("m")["_meta"].isNull(), say("meta_missing", "warning", F.lit("_meta"))),
        F.when(F.size(names) == 0, say("no_categories", "error", F.lit(""))), *lacks,
    ]
    told = F.filter(F.array(*first), lambda x: x.isNotNull())
    found = F.coalesce(F.concat(told, F.transform(no_lists, lambda k: say("category_no_list", "error", k))), told)  # no names without JSON
    problems = whole.select(F.explode(found).alias("p")).select("p.*")
    item = "array<struct<key:string,type:string,control:struct<input_type:string,options:array<struct<name:string,value:string>>>,`if`:array<struct<key:string>>>>"
    listed = whole.select(F.coalesce(meta["version"], F.lit("")).alias("version"), F.explode(F.map_filter("m", lambda k, v: F.array_contains(names, k))).alias("category", "body")).filter(F.ltrim("body").startswith("["))
    rows = listed.select("version", "category", F.posexplode(F.from_json("body", item)).alias("idx", "f")).withColumn("asks", F.explode_outer("f.if"))
    text = lambda part: F.coalesce(F.array_join(F.transform("f.control.options", lambda o: F.coalesce(o[part], F.lit(""))), "|"), F.lit(""))
    return rows.select("category", "idx", "f.key", "f.type", "f.control.input_type", text("name").alias("options"), text("value").alias("option_values"), F.col("asks.key").alias("if_key"), "version"), problems


def expanded_dictionary(spark: SparkSession, path: str, aliases: Sequence[tuple[str, str]], category: str, body: str, version: Callable[[str], str]) -> DataFrame:
    """One row, `value`: the dictionary's JSON with a category and aliases that it lacks, its version raised by a rule over a
    column and a note of that. Categories stay as they are written; values of `_meta` become texts."""
    given = F.from_json("value", "map<string,string>")
    own = F.from_json(F.coalesce(F.col("m")["aliases"], F.lit("{}")), "map<string,string>")
    new = F.map_from_entries(F.array(*(F.struct(F.lit(a).alias("key"), F.lit(k).alias("value")) for a, k in aliases)))
    meta = F.from_json(F.coalesce(F.col("m")["_meta"], F.lit("{}")), "map<string,string>")
    whole = spark.read.text(path, wholetext=True).select(given.alias("m")).withColumns({"own": own, "meta": meta})
    whole = whole.withColumn("was", F.coalesce(F.col("meta")["version"], F.lit("1.2.0"))).withColumn("version", F.expr(version("was")))
    note = F.concat(F.coalesce(F.col("meta")["notes"], F.lit("")), F.lit(" v"), F.col("version"), F.lit(f" adds the {category} template and aliases"))
    kept = lambda m, *names: F.map_filter(m, lambda k, _: ~k.isin(*names))
    raised = F.map_concat(kept("meta", "version", "notes"), F.create_map(F.lit("version"), F.col("version"), F.lit("notes"), note))
    every = F.map_concat(F.map_filter(new, lambda k, _: ~F.array_contains(F.map_keys("own"), k)), F.col("own"))
    added = F.when(F.col("m")[category].isNull(), F.create_map(F.lit(category), F.lit(body))).otherwise(F.from_json(F.lit("{}"), "map<string,string>"))
    parts = F.map_concat(F.create_map(F.lit("_meta"), F.to_json(raised)), kept("m", "_meta", "aliases"), added, F.create_map(F.lit("aliases"), F.to_json(every)))
    quoted = lambda k: F.substring(F.to_json(F.array(k)), 2, 1_000_000)  # noqa: E731  with the closing bracket still on
    pair = lambda e: F.concat(F.regexp_replace(quoted(e["key"]), r"\]$", ""), F.lit(": "), e["value"])
    return whole.select(F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(parts), pair), ", "), F.lit("}")).alias("value"))


def write_records(records: DataFrame, path: str) -> None:
    """One JSON line for each document, its records in order, with control and condition (`if`) as objects; nulls are kept."""
    control = F.from_json("control", "input_type string, hint string, agree_text string, html_text string, multi boolean, options array<struct<name:string,value:string>>")
    condition = F.from_json("condition", "array<struct<key:string,value:string>>")
    item = F.struct("place", "k", "key", "title", "section", "type", control.alias("control"), condition.alias("if"))
    nested = records.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("fields"))
    nested.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", "true").csv(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors share; a temporary one only in a local process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="formloom-")
    return f"{base.rstrip('/')}/formloom/{name}-{uuid.uuid4().hex}"
