"""A report of several parts makes its fields once."""

from formloom.functions.dialect import SPARK
from formloom.operators import reports


def test_performance_reads_its_documents_once(spark, tmp_path):
    spark.range(6).selectExpr("id % 3 AS doc_id", "'input' AS type", "'General' AS section", "concat('k', id) AS key", "id > 2 AS reused").write.parquet(str(tmp_path / "merged"))
    spark.range(3).selectExpr("id AS doc_id", "10L AS n_bytes", "10L AS n_chars", "2L AS n_lines").write.parquet(str(tmp_path / "sizes"))
    for name in ("merged", "sizes"):
        spark.read.parquet(str(tmp_path / name)).createOrReplaceTempView(f"report_{name}")
    made = spark.sql(reports.performance(SPARK, "SELECT * FROM report_merged", "SELECT * FROM report_sizes", "SELECT 'k1' AS t_key, 'General' AS t_section"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "/sizes]" not in plan  # in the table of documents, which is stored
    rows = {(r["part"], r["label"]): r["value"] for r in made.collect()}
    assert rows["overall", "documents"] == 3 and rows["overall", "lines"] == 6 and rows["dictionary", "matched"] == 3 and rows["type", "input"] == 6
