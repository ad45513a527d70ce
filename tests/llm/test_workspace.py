"""What staged tables leave behind."""
import time

from pyspark.sql import functions as F

from csvforge.llm.common import Workspace


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_when_a_table_is_staged(spark):
    ws, before = Workspace(spark, "tests"), _shuffle_files(spark)
    for i in range(3):
        assert ws.stage(spark.range(2000).groupBy((F.col("id") % 97 + i).alias("k")).count(), f"t{i}").count() == 97
    end = time.time() + 20
    while time.time() < end and len(_shuffle_files(spark) - before) > 3 * 8:
        time.sleep(0.2)
    ws.finish(spark.range(3))
    left = _shuffle_files(spark) - before
    end = time.time() + 20
    while time.time() < end and left:
        time.sleep(0.2)
        left = _shuffle_files(spark) & left
    assert not left


def test_tables_of_a_verification_go_when_its_links_are_written(spark):
    from csvforge.llm.jaccard import verified
    ws, text = Workspace(spark, "tests"), " ".join(f"w{i}" for i in range(60))
    docs = ws.stage(spark.createDataFrame([(0, text), (1, text + " end"), (2, "x y z")], "rid long, text string"), "docs")
    pairs = ws.stage(spark.createDataFrame([(0, 1), (0, 2)], "a long, b long"), "pairs")
    links = verified(docs, 3, pairs, ws, "first", 90, 100)
    assert [tuple(r) for r in links.collect()] == [(0, 1)]
    assert {path.rsplit("/", 1)[-1].count("first-") for _, path in ws.paths.values()} <= {0, 1}
    assert len(ws.paths) == 3
