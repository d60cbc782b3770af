"""What keeps the driver's memory level."""

import os

from formloom.llm import mixing, near_copies, simhash
from formloom.llm.common import discard, materialize


def test_stored_tables_have_no_marker(spark):
    df = materialize(spark.range(10).repartition(3), "marker")
    files = os.listdir(df._own_path.removeprefix("file://").removeprefix("file:"))
    assert df.count() == 10 and files and not any("_SUCCESS" in f for f in files)
    discard(df)


def test_what_follows_the_corpus_is_not_broadcast(spark, monkeypatch):
    """Spark sizes the rows of an explode by those before it, so a table of 32 rows a text went to the driver whole."""
    plans = {}

    def spy(df, name, narrow=False):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name, narrow)

    monkeypatch.setattr(near_copies, "materialize", spy)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 3 : 30 + i % 3]), "ab"[i % 2]) for i in range(12)], "doc_id long, text string, source string")
    assert [r["doc_id"] for r in simhash.keep_one(docs, words=5, alike=0.8).collect()] == [0]
    assert "SortMergeJoin" in plans["members"] and "Broadcast" not in plans["members"]

    mixed = mixing.mix(docs)
    joins = [x for x in mixed._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x and "bin#" in x]
    assert len(joins) == 2 and all("SortMergeJoin" in x for x in joins)
    assert mixed.count() == 12
