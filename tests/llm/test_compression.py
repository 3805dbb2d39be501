import zlib

import pytest

from lectern.llm import compression as c

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = c.op7_compression_quality(spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good, bad = [r for r in held if r.quality], [r for r in held if not r.quality]
    assert sum(r.predicted for r in good) >= 0.95 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.8 * len(bad)


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, 1, 0), (1, 0, 0), (2, None, None), (None, 0, 0)]])
def test_odd_rows(spark, labelled):
    docs = spark.createDataFrame([(1, "a b c", 5), (None, None, None), (2, "", 1), (1, "a b c", 5), (3, "z" * 100_000, 1)], "doc_id long, text string, score int")
    model = c.fit(docs, spark.createDataFrame(labelled, "doc_id long, quality int, toxic int"))
    got = c.scored(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert c.accepted(docs, model).columns == docs.columns
    assert c.scored(docs.limit(0), model).count() == 0


def test_blocks_cover_the_whole_text():
    model = c.Model(b"hello world " * 100, b"xyz" * 400, (0.0, 1.0, 0.0))
    text = b"hello world " * 500
    assert model.sizes(text)[0] == sum(model.sizes(text[i : i + c.BLOCK])[0] for i in range(0, len(text), c.BLOCK))


def test_scores_equal_plain_compression(spark):
    """Each score from two plain compressors, block by block, and one calibration of the size difference over the plain size."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = c.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert len(m.weights) == 2 and m.weights[1] > 0
    good, bad = (c.zstandard.ZstdCompressionDict(d) for d in (m.good, m.bad))
    size = lambda text, d: sum(len(c.zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_dict_id=False).compress(text[i : i + 1024])) for i in range(0, len(text), 1024))
    some = {r.doc_id: (r.text or "").encode() for r in docs.filter("doc_id % 9 = 0 OR n_chars > 30000").collect()}
    got = {r.doc_id: r.score for r in c.scored(docs, m).collect()}
    for i, text in some.items():
        e = (size(text, bad) - size(text, good)) / len(text) if text else 0.0
        x, p = m.knots
        k = sum(v <= e for v in x)
        steps = p[0] if k == 0 else p[-1] if k == len(x) else p[k - 1] + (p[k] - p[k - 1]) * (e - x[k - 1]) / (x[k] - x[k - 1])
        assert abs(got[i] - 0.99 * steps - 0.01 / (1 + c.np.exp(-(m.weights[0] + m.weights[1] * e)))) < 1e-9


def test_isotonic():
    r = c.np.random.default_rng(2)
    x, y, w = c.np.sort(r.normal(size=60)), r.integers(0, 2, 60).astype(float), r.random(60)
    at, p = c.isotonic(x, y, w)
    assert all(a < b for a, b in zip(p, p[1:])) and all(a < b for a, b in zip(at, at[1:]))
    # the fit at i is the largest of the least means of runs around it
    mean = lambda i, j: (w[i:j] @ y[i:j]) / w[i:j].sum()
    fit = [max(min(mean(i, j) for j in range(k + 1, 61)) for i in range(k + 1)) for k in range(60)]
    assert sorted(set(c.np.round(fit, 9))) == sorted(set(c.np.round(p, 9)))


def test_long_labelled_texts_are_learnt_from(spark):
    words = lambda k, n: " ".join(f"{k}{i * 7919 % 101}" for i in range(n))
    rows = [(i, words("good" if i % 2 else "bad", 20_000)) for i in range(24)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    m = c.fit(docs, labels)
    assert m.weights and all((r.score >= 0.5) == bool(r.doc_id % 2) for r in c.scored(docs, m).collect())
