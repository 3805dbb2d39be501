"""Tables between steps are compressed columns, and no join is sent whole through the driver."""

import os

from pyspark.sql import functions as F

from lectern.plans import textual
from lectern.session import checkpointed


def test_checkpointed_is_compressed_columns(spark):
    df = checkpointed(spark.range(200_000).select("id", F.lit("the same words in each row").alias("text"), (F.col("id") % 7).alias("k")))
    files = [f.removeprefix("file://").removeprefix("file:") for f in df.inputFiles()]
    assert files and all(f.endswith(".parquet") for f in files)
    # 42 bytes a row as they are
    assert sum(map(os.path.getsize, files)) < 200_000 * 42 // 4
    assert df.select(F.sum("id"), F.count("text"), F.max("k")).first() == (200_000 * 199_999 // 2, 200_000, 6)
    assert checkpointed(df.limit(0)).isEmpty()


def test_fuzzy_number_sends_no_table_to_all_tasks(spark, tmp_path):
    keys = [*range(1, 130), 1230, 1231, 2231]
    spark.createDataFrame([(k, k % 2) for k in keys], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    found = textual.fuzzy_number(spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    want = {(a, b) for a in keys for b in keys if a < b and a % 2 == b % 2 and near(str(a), str(b))}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_context_keeps_one_table_a_round(spark, monkeypatch):
    from lectern.operators import context

    kept = []
    monkeypatch.setattr(context, "checkpointed", lambda df: kept.append(1) or checkpointed(df))
    parts = spark.createDataFrame([(1, x, 2 * i + 1, False) for i, x in enumerate("abcd")], "doc long, label string, ord int, intro boolean")
    edges = spark.createDataFrame([(1, a, "part", 0, b, b, False) for a, b in ("dc", "cb", "ba")], "doc long, src string, kind string, n int, name string, dst string, alone boolean")
    units = spark.createDataFrame([("1/d", 1, "d")], "task string, doc long, label string")
    found = {(r.site, r.depth, r.dep) for r in context.context(units, parts, edges).collect()}
    assert found == {("c", 1, True), ("b", 2, True), ("a", 3, True)}
    # edges, tasks, four rounds of which the last adds nothing, and the rounds put together
    assert len(kept) <= 7


def test_audit_sorts_its_bands_three_times(spark):
    from lectern.operators import flow

    kinds = "unit long, item long, ord int, gap double, link string, page int, head_page int, head_top double, top double, bottom double, scale double"
    placed = spark.createDataFrame([(1, 1, 1, 0.0, "figure", 1, 1, 0.0, 80.0, 130.0, 1.0), (1, 1, 2, 4.0, None, 2, None, None, 0.0, 50.0, 1.0)], kinds)
    found = flow.audited(placed, "unit", "item", 150.0, 20.0)
    # every sort of a task holds its rows at the same time
    assert found._jdf.queryExecution().executedPlan().toString().count("Sort [") == 3
    assert [(r.ord, r.finding, r.size) for r in found.collect()] == [(1, "split figure", 104.0)]


def test_multiset_coverage_counts_words_of_few_texts(spark, tmp_path, monkeypatch):
    """Common words in all texts, a rare one an item: words are counted only of the texts that have some of an item's rarest."""
    common = [f"w{i}" for i in range(30)]
    items = [(i, " ".join([*common, "w0", "w0", f"rare{i}", "last"])) for i in range(4)] + [(4, "only twice twice")]
    lacking = " ".join([*common[1:], "w0", "w0", "w0", "rare1"])
    docs = [(i, " ".join(common)) for i in range(200)] + [(300, items[0][1].upper()), (301, lacking), (302, lacking.replace("w5 ", "")), (303, "only twice"), (304, "only twice, twice!"), (305, None)]
    docs += [(306, "only twice"), (306, "twice"), (None, "only twice twice")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counted, plain = [], textual.T.word_counts
    monkeypatch.setattr(textual.T, "word_counts", lambda df, key, *more: counted.append((key, df.count())) or plain(df, key, *more))
    found = {tuple(r) for r in textual.multiset_coverage(spark, str(tmp_path)).collect()}
    assert found == {(0, 300, 34, 34), *((i, 300, 33, 34) for i in (1, 2, 3)), (1, 301, 33, 34), (4, 304, 3, 3), (4, 306, 3, 3), (4, None, 3, 3)}
    assert sum(n for key, n in counted if key == "doc_id") < 20, counted


def static_broadcasts(spark, monkeypatch, query):
    """How many joins of a query and of what it keeps are planned to send a table to all tasks, before any is measured."""
    import sys

    found = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    count = lambda df: found.append(plan(df).count("BroadcastHashJoin") + plan(df).count("BroadcastNestedLoopJoin"))
    for name in [m for m in sys.modules if m.startswith("lectern.") and m != "lectern.session" and hasattr(sys.modules[m], "checkpointed")]:
        monkeypatch.setattr(sys.modules[name], "checkpointed", lambda df: count(df) or checkpointed(df))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        count(query(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(found) > 2
    return sum(found)


def test_kept_table_is_not_sent_to_all_tasks(spark):
    """Its files are a hundredth of its rows, which Spark would otherwise take for small."""
    one = spark.range(400_000).select("id", F.lit("the same words in each row").alias("text"))
    many, few = checkpointed(one), checkpointed(one.filter("id < 1000"))
    grouped = many.filter("id % 2 = 0").groupBy("id").agg(F.min("text").alias("text"))
    for df in (many.join(few.select("id"), "id"), few.select("id").join(grouped, "id", "left")):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 1000


def test_item_queries_send_no_kept_table_to_all_tasks(spark, monkeypatch):
    from lectern.plans import items

    assert static_broadcasts(spark, monkeypatch, items.item_assembly) == 0
    assert static_broadcasts(spark, monkeypatch, items.item_coverage) == 0


def test_context_closure_sends_no_kept_table_to_all_tasks(spark, monkeypatch):
    from lectern.plans import closures

    assert static_broadcasts(spark, monkeypatch, closures.context_closure) == 0


def test_running_text_sorts_its_words_once(spark):
    import pyarrow as pa

    from lectern.operators import running

    words = spark.createDataFrame([(1, 1, 50.0, 100.0, 56.0, 110.0, "1"), (1, 1, 500.0, 100.0, 518.0, 110.0, "[2]")], "doc_id long, page int, x0 double, y0 double, x1 double, y1 double, text string")
    expected = spark.createDataFrame([(1, 1, None, None, 0)], "doc_id long, q int, letter string, roman string, ord int")
    found = running.followed(words, expected)
    assert found._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    assert [(r.q, r.begins, [m.n for m in r.marks]) for r in found.collect()] == [(1, True, [2])]
    for column in (pa.array([1, None, -1]), pa.array([2**62 + 1, 3]), pa.array(["a", None]), pa.array([1.5, 2.0]), pa.array([True, None]), pa.array([], pa.int32())):
        assert running.plain(column) == column.to_pylist()


def test_scheme_table_rows_sends_no_kept_table_to_all_tasks(spark, monkeypatch):
    from lectern.plans import schemes

    assert static_broadcasts(spark, monkeypatch, schemes.scheme_table_rows) == 0
