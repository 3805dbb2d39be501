"""Words in context: what stands before and after decides, and what tables list."""

from lectern.operators import mentions as M


def table(spark, name, words):
    return spark.createDataFrame([(w,) for w in words], f"{name} string")


def test_anaphora(spark):
    texts = [(1, "This program runs. Write the table. The same robots move; the table below is new."), (2, "Those"), (3, None), (4, ""), (5, "see THE boxes")]
    cues = spark.createDataFrame([("before", "write"), ("after", "below"), ("modifier", "same"), ("modifier", "same")], "kind string, word string")
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id long, text string, noun string")
    nouns = table(spark, "noun", ["program", "table", "robot", "box", "box"])
    got = sorted(tuple(r) for r in M.anaphora(docs, "doc_id", "text", nouns, cues).collect())
    assert got == [(1, 0, "program"), (1, 6, "robot"), (5, 1, "box")]
    assert M.anaphora(docs, "doc_id", "text", nouns.limit(0), cues).count() == 0
    bare = {r.n for r in M.anaphora(docs, "doc_id", "text", nouns, cues.limit(0)).filter("doc_id = 1").collect()}
    assert bare == {0, 4, 10}


def test_identifiers(spark):
    text = 'Run GetName() and TBL_ORDER, then "HiddenName" // OLD_NAME\nwrite Log.txt with WiFi, x() and a plain word. GetName()'
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = sorted(r.word for r in M.identifiers(docs, "doc_id", "text", table(spark, "word", ["wifi"])).collect())
    assert got == ["GetName", "Log.txt", "TBL_ORDER"]


def test_labels(spark):
    docs = spark.createDataFrame([(1, "Acids A, B and C react with ester D or E. gases F to H, Plan K"), (1, "ester D"), (2, None)], "doc_id long, text string")
    got = sorted((r.noun, r.label) for r in M.defined_labels(docs, "doc_id", "text", table(spark, "noun", ["ester", "gase"])).collect())
    assert got == [("ester", "D"), ("ester", "E"), ("gase", "F"), ("gase", "H")]
