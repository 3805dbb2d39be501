import pytest
from pyspark.sql import functions as F

from lectern.llm import _common as c


def test_kept_and_discarded(spark):
    df = c.kept(spark.range(5).withColumn("x", F.lit(None).cast("string")), "five")
    assert df.count() == 5 and df.columns == ["id", "x"]
    assert c.shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(path).count() == 5
    c.discard(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_words(spark):
    rows = [(None, 0), ("", 0), (" \t\n", 0), ("a\u00a0b c\x0bd\x0ce\r\nf", 5), ("a\x1cb", 1)]
    got = spark.createDataFrame(rows, "t string, n int").select(F.size(c.words(F.col("t"))).alias("found"), "n").collect()
    assert all(r.found == r.n for r in got)


class Context:
    """As much of a context as shared_dir looks at, without spark.checkpoint.dir."""

    def __init__(self, master):
        self.master, self.dir, self.conf = master, None, self
        self.sparkContext = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path + "/x"


def test_shared_dir_where_the_key_is_unset():
    one = Context("local[4]")
    assert c.shared_dir(one) == c.shared_dir(one) and c.shared_dir(one).startswith("file:///")
    for master in ("yarn", "spark://host:7077", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            c.shared_dir(Context(master))
