import re
from collections import Counter

import corpus_pipeline
from lectern.llm import compression, mixing, simhash
from tests.llm.test_decontaminate import brute as similarity
from tests.llm.test_nearcopies import brute_stays

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_inputs(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, columns = [docs], docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
    raw, good, single, clean, mix, shards = ([tuple(r) for r in x.collect()] for x in seen)
    assert all(x.columns == columns for x in seen[:-1])
    model = compression.fit(seen[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(good) == sorted(r for r in raw if model.score((r[1] or "").encode()) >= 0.3)
    assert sorted(r[0] for r in single) == brute_stays([(r[0], r[1]) for r in good])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[^\W_]+", t.lower())] for i in range(len(w) - 4)}
    known = set().union(*map(shingles, items))
    suspects = [r for r in single if shingles(r[1]) & known]
    bad = {r[0] for r in suspects if any(shingles(r[1]) & shingles(t) and similarity(r[1], t) >= 0.8 for t in items)}
    assert bad and sorted(clean) == sorted(r for r in single if r[0] not in bad)
    copies = {r.doc_id: r.copies for r in mixing.mixed(seen[3], share=(4, 5)).collect()}
    assert Counter(r[0] for r in mix) == +Counter(copies)
    assert Counter(r[0] for r in shards) == Counter(r[0] for r in mix)


def test_deduplicated_keeps_one_row_a_group(spark):
    text = "one two three four five six"
    rows = [(2, text), (2, text), (1, text), (1, text), (None, text), (None, "other"), (None, "other"), (5, None), (6, ""), (7, "alone here")]
    docs = spark.createDataFrame([(*r, i, 0, 0) for i, r in enumerate(rows)], "doc_id long, text string, fingerprint int, __fingerprint int, __Fingerprint_ int")
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("1", text), ("5", None), ("7", "alone here"), ("None", "other")]
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def test_mixing_leaves_clashing_columns_alone(spark):
    names = ["doc_id", "text", "lang", "source", "__id", "__domain", "__mixid", "__copies", "budget"]
    docs = spark.createDataFrame([(i, "a b c " * (i % 5 + 1), "en", f"src{i % 3}", *["mine"] * 5) for i in range(30)], names)
    got = mixing.resampled(docs, share=(9, 5))
    assert got.columns == names and got.count() > 30
    assert all(set(r[4:]) == {"mine"} for r in got.collect())
