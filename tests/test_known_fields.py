"""Rules over fields that run once for each title and key that forms share, and results that are stored rather than made again."""

import os

import pytest

from formloom.operators import grids, known, records, validate
from formloom.plans import queries

SF = "/root/testdata/sf0.001"
SHARED = ["Insurance", "Policy Number: ____", "Local Anesthesia Sulfa Drugs Other [ ] Local Anesthesia [ ] Sulfa Drugs [ ] Other", "General", "Diabetes, asthma and stroke: ____", "Asthma: ____", "Colour of eyes: ____", "How did you hear about us? [ ] Friend [ ] Internet", "Signature: ____ Date: ____"]
OPERATORS = {
    "voted": records.voted_sections, "inferred": records.inferred_sections, "preferred": records.in_preferred_section, "semantic": records.semantic_duplicates, "consolidated": records.consolidated,
    "conditions": records.merged_conditions, "continued": records.joined_continuations, "types": records.final_types, "violations": validate.violations,
}


def fields(spark, name):
    rows = [(doc, pos, x) for doc in range(4) for pos, x in enumerate([*SHARED, f"Own {doc} disease: ____", f"Primary Insurance {doc}", "Phone: ____"])]
    spark.createDataFrame(rows, "doc_id long, pos long, line string").createOrReplaceTempView(name)
    return records.fields(queries.SPARK, f"SELECT * FROM {name}")


@pytest.mark.parametrize("name", OPERATORS)
def test_rules_of_known_fields_change_nothing_and_are_looked_up(spark, name):
    source, d = fields(spark, "_known_fields"), queries.SPARK
    got = spark.sql(OPERATORS[name](d, source))
    plain = spark.sql(OPERATORS[name](d, "" + source))  # a plain text knows nothing of its rows
    looked = lambda df: df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")
    assert looked(got) > looked(plain) == 2  # of lines and of parts
    rows = sorted(map(str, got.collect()))
    assert got.columns == plain.columns and rows == sorted(map(str, plain.collect())) and rows


def test_staged_fields_stay_known(spark):
    source = fields(spark, "_staged_fields")
    staged = known.staged(queries.SPARK, source)
    assert staged.known == source.known and not hasattr(known.staged(queries.SPARK, "SELECT 1 AS a"), "known")
    held = {(r.title, r.key) for r in spark.sql(source.known).collect()}
    assert ("Policy Number", "policy_number__primary") in held and ("Policy Number", "policy_number") in held


def test_no_lookup_where_none_is_wanted(spark):
    spark.createDataFrame([(1, 1, None, "a"), (1, 2, 1, "b"), (1, 3, 9, "c")], "doc_id long, place long, parent long, key string").createOrReplaceTempView("_parents")
    looked = queries.SPARK.lookup("place", "key", "parent", "OVER (PARTITION BY doc_id)")
    assert looked.startswith("CASE WHEN parent IS NOT NULL")
    assert sorted(map(tuple, spark.sql(f"SELECT key, {looked} AS up FROM _parents").collect())) == [("a", None), ("b", "a"), ("c", None)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_records_read_stored_fields(spark, monkeypatch):
    """The chain from lines to fields is run once, not for the counting and again for the records; nor are grids' lines."""
    judged = []
    monkeypatch.setattr(grids, "questions", lambda d, tables, f=grids.questions: (judged.append(tables), f(d, tables))[1])
    found = queries.queries()["records"](spark, SF)
    assert not [f for f in found.inputFiles() if "customer" in f] and judged[0].startswith("SELECT * FROM stored_")
    assert found.count() > 0
