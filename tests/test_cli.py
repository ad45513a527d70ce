from csvforge.__main__ import main

from helpers import write


def test_cli_imports_files(spark, tmp, capsys):
    write(f"{tmp}/in/cars.csv", "YEAR|MAKE\n1997|Ford\n")
    main(["--input", f"{tmp}/in", "--output", f"{tmp}/out", "--csv_delimiter", "|"], spark=spark)
    assert "cars:" in capsys.readouterr().out
    assert [tuple(r) for r in spark.read.parquet(f"{tmp}/out/cars").collect()] == [(1997, "Ford")]


def test_cli_skips_bad_headers(spark, tmp, capsys):
    write(f"{tmp}/in2/good.csv", "name,cnt\nq,1\n")
    write(f"{tmp}/in2/bad.csv", "1997,Ford\n")
    main(["--input", f"{tmp}/in2", "--output", f"{tmp}/out2", "--bad_headers", "skip"], spark=spark)
    out = capsys.readouterr().out
    assert "good:" in out and "skipped" in out and "bad.csv" in out
