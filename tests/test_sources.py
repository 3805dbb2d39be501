import pytest

from lectern.sources import readers, sinks


def test_tag_lines(spark, tmp_path):
    (tmp_path / "tags.txt").write_text("# note\n\ns20_11 Q3: a.i=3.5 b=2?\ns20_12 Q1: Q=1\n")
    got = sorted(map(tuple, readers.tag_lines(spark, str(tmp_path / "tags.txt")).collect()))
    assert got == [("s20_11", 3, "a.i", "3.5", True), ("s20_11", 3, "b", "2", False), ("s20_12", 1, "Q", "1", True)]


def test_ocr_words(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "x.tsv").write_text(head + '5\t1\t1\t1\t1\t1\t300\t600\t150\t75\t91.5\t"q\n4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t\n5\t1\t1\t1\t1\t2\t0\t0\t1\t1\t9\t \n')
    (r,) = readers.ocr_words(spark, str(tmp_path / "x.tsv")).collect()
    assert (r.page, r.x0, r.y0, r.x1, r.y1, r.conf, r.text) == (1, 72.0, 144.0, 108.0, 162.0, 91.5, '"q')


def test_json_and_csv(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "v": "x"}\nbroken\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k INT, v STRING").collect()
    assert [(r.k, r._corrupt_record) for r in rows] == [(1, None), (None, "broken")]
    (tmp_path / "d.json").write_text('{\n "k": 2\n}')
    assert readers.json_document(spark, str(tmp_path / "d.json"), "k INT").first().k == 2
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    sinks.csv_index(df, f"{tmp_path}/csv", one_file=True)
    assert sorted(map(tuple, readers.csv_table(spark, f"{tmp_path}/csv", "k INT, v STRING").collect())) == [(1, "a,b"), (2, None)]
    sinks.json_lines(df, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    sinks.by_unit(df, f"{tmp_path}/unit", "k")
    assert spark.read.parquet(f"{tmp_path}/unit").filter("k = 2").count() == 1


def test_markdown(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "unit string, n int").orderBy("unit")
    (tmp_path / "r.md").write_text("# Report\n\n## Units\n\n" + sinks.markdown(df) + "\n\n## Next\n| x |\n|---|\n| 1 |\n")
    got = readers.markdown_table(spark, str(tmp_path / "r.md"), "Units").orderBy("row").collect()
    assert [(r.row, r.cells) for r in got] == [(0, ["a", "1"]), (1, ["b", ""])]
    with pytest.raises(ValueError, match="no report"):
        sinks.markdown(df, 1)


def test_key_space_and_batches(spark, tmp_path):
    keys = readers.key_space(spark, range(2019, 2021), ["m", "s"], [11, 12])
    assert keys.count() == 8 and {"m19_11", "s20_12"} <= {r.pid for r in keys.collect()}
    sinks.batches(spark.range(200), ["id"], 75, f"{tmp_path}/b")
    got = spark.read.parquet(f"{tmp_path}/b/batches")
    assert sorted((r.batch, r["min(id)"], r["max(id)"]) for r in got.groupBy("batch").agg({"id": "min"}).join(got.groupBy("batch").agg({"id": "max"}), "batch").collect()) == [(0, 0, 74), (1, 75, 149), (2, 150, 199)]


def test_session_stream(spark, tmp_path):
    from lectern.streaming.sessions import session_counts

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{tmp_path}/in")
    events = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    q = session_counts(events, late="100 days").writeStream.outputMode("append").format("memory").queryName("sessions").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("sessions").columns == ["user_id", "start", "end", "n"]
