"""Rules that run once for each line that documents share, and forms dealt before their lines are made."""

import os

import pytest

from formloom.functions import text
from formloom.operators import catalog, classifier, known, records
from formloom.operators import lines as line_operators
from formloom.operators.known import with_rules
from formloom.plans import queries

SF = "/root/testdata/sf0.001"
SHARED, OWN = ["pat1ent ph0ne", "", "Name: ____", "[ ] Yes [ ] No"], [f"ema1l {i}: ____" for i in range(5)]


def lines(spark, name):
    rows = [(doc, pos, x) for doc in range(5) for pos, x in enumerate([*SHARED, OWN[doc], *([None] if doc < 2 else [])])]
    spark.createDataFrame(rows, "doc_id long, pos long, line string").createOrReplaceTempView(name)
    return f"SELECT * FROM {name}"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["label_characters", "option_text", "term_corrections"])
def test_forms_of_one_row_group_are_many_tasks(spark, name):
    assert queries.queries()[name](spark, SF).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("most", [0, 1, 8192])
def test_known_lines_change_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(known, "MOST", most)
    source, d = lines(spark, "_known"), queries.SPARK
    steps = [{"t": text.preprocess(d, "line", label=True)}, {"n": "length(t)"}]
    got = spark.sql(with_rules(d, source, ["line"], steps))
    want = spark.sql(known.layered(source, steps))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert spark.sql(known.frequent(source, ["line"])).count() == min(most, len(SHARED))
    fields = sorted(map(str, spark.sql(records.fields(d, source)).collect()))
    monkeypatch.setattr(known, "MOST", 8192 if most < 2 else 0)
    assert fields and fields == sorted(map(str, spark.sql(records.fields(d, source)).collect()))


def test_rules_are_looked_up(spark):
    """The fields' plan joins a table of known lines and one of known parts by broadcast."""
    plan = spark.sql(records.fields(queries.SPARK, lines(spark, "_looked")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_samples_are_stored_and_the_same(spark):
    """The classifier's samples are computed once, not in each pass of its training."""
    around = line_operators.around(queries.SPARK, lines(spark, "_samples"))
    got, want = classifier.labelled_once(spark, around), classifier.labelled(spark.sql(around))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_samples_are_known_by_their_line_alone(spark, monkeypatch):
    """A line beside one that no other document has was judged anew; now only lines of which there is one are."""
    tables, learn = [], known.learn
    monkeypatch.setattr(known, "learn", lambda *given: tables.append(learn(*given)) or tables[-1])
    rows = [(doc, pos, line) for doc in range(3) for pos, line in enumerate([f"Name {doc}: ____", "Date of Birth: ____", f"Form {doc}"])]
    spark.createDataFrame(rows, "doc_id long, pos long, line string").createOrReplaceTempView("_beside")
    around = line_operators.around(queries.SPARK, "SELECT * FROM _beside")
    got, want = classifier.labelled_once(spark, around), classifier.labelled(spark.sql(around))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 9
    assert [r["line"] for r in spark.sql(tables[0]).collect()] == ["Date of Birth: ____"]


@pytest.mark.parametrize("most", [0, 2, 8192])
def test_known_fields_are_matched_alike(spark, monkeypatch, most):
    monkeypatch.setattr(known, "MOST", most)
    d = queries.SPARK
    of = [("first_name", "First Name", "Patient Information", ""), ("x", "Policy Number", "Insurance", ""), ("q", "Weather", "General", "a|b"), ("y", "Sex", "General", None)]
    rows = [(doc, i, 0, *f) for doc in range(3) for i, f in enumerate([*of, (f"own_{doc}", "Date of Birth", "General", "")])]
    spark.createDataFrame(rows, "doc_id long, pos long, sub long, key string, title string, section string, options string").createOrReplaceTempView("_alike")
    got, want = spark.sql(catalog.best(d, "SELECT * FROM _alike")), spark.sql(catalog.staged_best(d, "SELECT * FROM _alike"))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 15


def test_one_signature_reads_fields_once(spark):
    spark.createDataFrame([(1, 0, 0, "a", "input"), (1, 1, 0, "b", "block_signature"), (1, 2, 0, "c", "signature"), (2, 0, 0, "d", "input")], "doc_id long, pos long, sub long, title string, type string").createOrReplaceTempView("_sign")
    got = spark.sql(records.one_signature(queries.SPARK, "SELECT * FROM _sign"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0, "b"), (2, None, None, "Signature")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
