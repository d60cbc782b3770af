from formloom.functions.dialect import DUCK, SPARK
from formloom.operators.records import first_of

ROWS = "VALUES (1, 'a', 1), (1, 'a', 2), (1, 'b', 3), (1, NULL, 4), (1, NULL, 5), (2, NULL, 6), (2, 'a', 7), (2, 'a', 8), (3, 'a', 9), (NULL, 'a', 10), (NULL, 'a', 11), (NULL, NULL, 12)"
SOURCE = f"SELECT doc_id, key, pos FROM ({ROWS}) AS t(doc_id, key, pos)"


def test_first_of_keys_in_a_window_of_the_document(spark):
    """One group for each document, not one for each key, of which there are about as many as rows; null keys are alike."""
    import duckdb

    query = first_of(SPARK, SOURCE, "doc_id, key", "pos", "doc_id, key, pos")
    made = spark.sql(query)
    want = [(1, "a", 1), (1, "b", 3), (1, None, 4), (2, None, 6), (2, "a", 7), (3, "a", 9), (None, "a", 10), (None, None, 12)]
    assert sorted(map(tuple, made.collect()), key=lambda r: r[2]) == want
    assert sorted(duckdb.sql(first_of(DUCK, SOURCE, "doc_id, key", "pos", "doc_id, key, pos")).fetchall(), key=lambda r: r[2]) == want
    last = [r[2] for r in spark.sql(first_of(SPARK, SOURCE, "doc_id, key", "pos DESC", "doc_id, key, pos")).collect()]
    assert sorted(last) == [2, 3, 5, 6, 8, 9, 11, 12]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "WindowGroupLimit" not in plan and "[doc_id#" in plan
