from __future__ import annotations

import glob

from pyspark.sql import functions as F

from oreflow.session import build_session, materialise, scratch_path, scratch_root, size_in_bytes, spread
from oreflow.sources import files, reports


def write(path, text):
    with open(path, "w") as out:
        out.write(text)


def read_back(path):
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_survey_picks_columns_by_name(spark, tmp_path):
    write(tmp_path / "s.csv", 'Id,Salary,Country,SalaryType,Hobby\n1,"1,000","Congo, Republic of",Monthly,x\n2,NA,B,,y\n3,,B,,\n')
    scan = files.read_survey(spark, str(tmp_path))
    assert [tuple(r) for r in scan.collect()] == [
        ("Congo, Republic of", "1,000", "Monthly"),
        ("B", "NA", None),
        ("B", None, None),
    ]
    assert "ReadSchema: struct<Salary:string,Country:string,SalaryType:string>" in scan._jdf.queryExecution().toString()


def test_ratings_and_baskets(spark, tmp_path):
    write(tmp_path / "r.csv", "userId,movieId,rating\nu1,i1,4.5\nu2,i1,3\n")
    rows = files.read_ratings(spark, str(tmp_path / "r.csv")).collect()
    assert [tuple(r) for r in rows] == [("u1", "i1", 4.5), ("u2", "i1", 3.0)]
    write(tmp_path / "b.csv", "1,a\n1,b\n2,a\n")
    rows = files.read_baskets(spark, str(tmp_path / "b.csv")).collect()
    assert [tuple(r) for r in rows] == [("1", "a"), ("1", "b"), ("2", "a")]


def test_documents_keep_equal_lines_apart(spark, tmp_path):
    write(tmp_path / "d.txt", "a b\na b\n\nc\n")
    rows = files.read_documents(spark, str(tmp_path / "d.txt")).collect()
    assert [r["text"] for r in rows] == ["a b", "a b", "", "c"]
    assert len({r["doc_id"] for r in rows}) == 4


def test_csv_report_quotes_commas(spark):
    df = spark.createDataFrame([("Z", 1), ("B, Republic of", 2)], "country string, n bigint")
    path = scratch_path(spark, "csv")
    reports.write_csv(df, path, order=["country"], one_file=True)
    assert read_back(path) == '"B, Republic of",2\nZ,1\n'


def test_predictions_are_quoted_and_sorted_as_text(spark):
    rows = [("10", "b", 2.5), ("9", "a", 1.0), ("10", "a", 3.0)]
    df = spark.createDataFrame(rows, "user string, item string, prediction double")
    path = scratch_path(spark, "predictions")
    reports.write_predictions(df, path)
    assert read_back(path) == '"10","a","3.0"\n"10","b","2.5"\n"9","a","1.0"\n'


def test_sorted_reports_are_range_partitioned(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("user"))
    plan = df.orderBy("user")._jdf.queryExecution().toString()
    assert "rangepartitioning(user" in plan


def test_materialise_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "k int, v array<string>")
    back = materialise(df, "t")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema]


def test_scratch_folder_comes_from_the_session(spark, tmp_path):
    assert scratch_root(spark) == scratch_root(spark)
    other = spark.newSession()
    assert scratch_path(other, "x").startswith(scratch_root(spark))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_small_inputs_are_spread_and_large_ones_left(spark):
    small = spark.range(10).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    large = spark.range(10**12)
    assert size_in_bytes(large) > 1 << 40
    assert spread(large) is large


def test_session_settings(spark):
    again = build_session()
    assert again.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
