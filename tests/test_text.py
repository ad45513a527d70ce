from pyspark.sql import functions as F

from csvforge.functions import text


def test_uri_helpers(spark):
    uris = ["s3a://bucket/dir/file.csv", "s3a://bucket/file", "s3a://b/x/y.tar.gz", "s3a://bucket",
            "no-scheme/path.csv", "hdfs://nn:8020/data/a b.csv"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    rows = df.select("u", text.uri_bucket(F.col("u")).alias("b"), text.uri_path(F.col("u")).alias("p"),
                     text.base_name(F.col("u")).alias("n"), text.table_name(F.col("u")).alias("t")).collect()
    got = {r.u: (r.b, r.p, r.n, r.t) for r in rows}
    assert got["s3a://bucket/dir/file.csv"] == ("bucket", "dir/file.csv", "file", "file")
    assert got["s3a://bucket/file"] == ("bucket", "file", "file", "file")
    assert got["s3a://b/x/y.tar.gz"] == ("b", "x/y.tar.gz", "y.tar", "y_tar")
    assert got["s3a://bucket"] == (None, None, None, "bucket")   # no object path: not a URI, a plain name
    assert got["no-scheme/path.csv"][3] == "path"
    assert got["hdfs://nn:8020/data/a b.csv"][3] == "a_b"


def test_generate_uri_and_pretty(spark):
    df = spark.createDataFrame([("b", "dir/x.csv", ["a", "b", "c"])], "b string, p string, l array<string>")
    r = df.select(text.generate_uri("s3a", F.col("b"), F.col("p")).alias("u"),
                  text.pretty(F.col("l")).alias("s")).first()
    assert r.u == "s3a://b/dir/x.csv" and r.s == "a, b, c"
