import duckdb

from lectern.llm import mixing as m


def test_sources_without_a_number(spark, tmp_path):
    sources = ["wiki", "", "src4", "src99999999999", None]
    docs = spark.createDataFrame([(i, "w " * (i % 9), "en", sources[i % 5], 1) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = sorted(map(repr, map(tuple, m.op1_budget_tree(spark, str(tmp_path)).collect())))
    assert found == sorted(map(repr, con.execute(m.ORACLES["op1_budget_tree"]).fetchall()))
    assert m.resampled(docs, share=(1, 1), epochs=1).count() == 60
