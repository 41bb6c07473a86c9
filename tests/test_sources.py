import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from beatwise.schemas import CENSUS_DOC_SCHEMA
from beatwise.sources import (
    collect_then_write, formatted_plan, ingest_census, read_csv, read_csv_lines, read_delimited_fields, read_feature_docs,
    read_feature_docs_text, read_parquet, write_csv, write_feature_docs, write_parquet,
)

SCHEMA = StructType([StructField("id", StringType()), StructField("TIME OCC", StringType())])


def test_csv_two_files_as_one(spark, tmp_dir):
    write_csv(spark.createDataFrame([("1", "0600"), ("2", "1300")], SCHEMA), f"{tmp_dir}/a")
    write_csv(spark.createDataFrame([("3", "2300")], SCHEMA), f"{tmp_dir}/b", single_file=True)
    df = read_csv(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"], SCHEMA)
    assert sorted(r.id for r in df.collect()) == ["1", "2", "3"]
    lines = read_csv_lines(spark, [f"{tmp_dir}/a/*.csv", f"{tmp_dir}/b/*.csv"], SCHEMA)
    assert sorted(tuple(r) for r in lines.collect()) == sorted(tuple(r) for r in df.collect())


def test_semicolon_csv_and_split_lines(spark, tmp_dir):
    schema = StructType([StructField(c, StringType()) for c in ("Zip_Code", "Community", "Income")])
    src = spark.createDataFrame([("90001", "A", "$1,000"), ("90002", "B;C", "$2")], schema)
    write_csv(src, f"{tmp_dir}/inc", sep=";")
    back = read_csv(spark, f"{tmp_dir}/inc", schema, sep=";")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in src.collect())
    split = read_delimited_fields(spark, f"{tmp_dir}/inc/*.csv", schema.fieldNames(), sep=";",
                                  header_first_field="Zip_Code")
    # Plain splitting ignores quoting: the quoted 'B;C' breaks into two fields.
    assert sorted(r.Zip_Code for r in split.collect()) == ["90001", "90002"]
    assert {r.Community for r in split.collect()} == {"A", '"B'}


def test_feature_docs_round_trip(spark, tmp_dir):
    props = StructType([StructField("ZCTA20", StringType()), StructField("POP20", LongType()),
                        StructField("HOUSING20", LongType()), StructField("EXTRA", StringType())])
    rows = [(i, "Feature", (str(90000 + i % 3), i, 1, "x")) for i in range(25)]
    feats = spark.createDataFrame(rows, StructType([StructField("key", LongType()), StructField("type", StringType()),
                                                    StructField("properties", props)]))
    write_feature_docs(feats, f"{tmp_dir}/docs", key_col="key", features_per_doc=10)
    files = [p for p in __import__("os").listdir(f"{tmp_dir}/docs") if p.endswith(".json")]
    assert len(files) == 3
    for read in (read_feature_docs, read_feature_docs_text):
        docs = read(spark, f"{tmp_dir}/docs", CENSUS_DOC_SCHEMA)
        flat = docs.selectExpr("inline(features)").select("properties.*")
        assert flat.columns == ["ZCTA20", "POP20", "HOUSING20"]
        assert sorted(r.POP20 for r in flat.collect()) == list(range(25))


def test_parquet_round_trip_and_collect_then_write(spark, tmp_dir):
    df = spark.createDataFrame([("1", "0600")], SCHEMA)
    back = read_parquet(spark, write_parquet(df, f"{tmp_dir}/pq"))
    assert back.collect() == df.collect()
    rows = collect_then_write(back, f"{tmp_dir}/out", single_file=True)
    assert rows == df.collect()
    assert read_csv(spark, f"{tmp_dir}/out", SCHEMA).collect() == df.collect()


def test_formatted_plan(spark):
    text = formatted_plan(spark.range(10).groupBy("id").count())
    assert "== Physical Plan ==" in text and "HashAggregate" in text


def test_quoted_line_break_splits_a_record(spark, tmp_dir):
    # Like the surveyed readers, no multiLine option: each physical line is a record.
    path = f"{tmp_dir}/broken.csv"
    with open(path, "w") as f:
        f.write('id,TIME OCC\n"1","06\n00"\n"2","1300"\n')
    rows = read_csv(spark, path, SCHEMA).collect()
    assert len(rows) == 3
    assert rows[-1] == ("2", "1300")


TEXT = 'id,TIME OCC\n"1","0600"\n\n   \n2\n"id","TIME OCC"\n3,1300\n'


def test_text_lines_follow_the_csv_reader(spark, tmp_dir):
    path = f"{tmp_dir}/odd.csv"
    with open(path, "w") as f:
        f.write(TEXT)
    lines = sorted(map(tuple, read_csv_lines(spark, path, SCHEMA).collect()))
    assert lines == [("1", "0600"), ("2", None), ("3", "1300")]
    by_csv = sorted(map(tuple, read_csv(spark, path, SCHEMA).filter("id != 'id'").collect()))
    assert [r for r in by_csv if r[0].strip()] == lines


def test_a_quoted_header_is_no_record(spark, tmp_dir):
    path = f"{tmp_dir}/quoted.csv"
    with open(path, "w") as f:
        f.write('"id","TIME OCC"\n1,0600\n')
    assert read_csv_lines(spark, path, SCHEMA).collect() == read_csv(spark, path, SCHEMA).collect()
    typed = StructType([StructField("id", LongType()), StructField("TIME OCC", LongType())])
    assert [tuple(r) for r in read_csv_lines(spark, path, typed).collect()] == [(1, 600)]


def test_split_lines_with_blank_and_short_lines(spark, tmp_dir):
    path = f"{tmp_dir}/short.txt"
    with open(path, "w") as f:
        f.write("Zip_Code;Community;Income\n\n90001;A;$1\n90002\n  \n;B;$2\n")
    rows = read_delimited_fields(spark, path, ["Zip_Code", "Community", "Income"], header_first_field="Zip_Code")
    assert sorted(map(tuple, rows.collect())) == [("", "B", "$2"), ("90001", "A", "$1"), ("90002", None, None)]


def test_only_small_results_are_collected(spark, tmp_dir):
    with pytest.raises(ValueError, match="more than 5 rows"):
        collect_then_write(spark.range(10), f"{tmp_dir}/out", max_rows=5)


def test_census_ingest_writes_many_files(spark, tmp_dir):
    rows = [(i, "Feature", (str(90000 + i % 3), i, 1)) for i in range(40)]
    feats = spark.createDataFrame(
        rows, "key long, type string, properties struct<ZCTA20:string, POP20:long, HOUSING20:long>")
    write_feature_docs(feats, f"{tmp_dir}/docs", key_col="key", rows=40)
    out = ingest_census(spark, f"{tmp_dir}/docs", CENSUS_DOC_SCHEMA, f"{tmp_dir}/flat", files=4)
    back = read_parquet(spark, out)
    assert back.columns == ["ZCTA20", "POP20", "HOUSING20"] and len(back.inputFiles()) == 4
    assert sorted(map(tuple, back.collect())) == sorted(p for _, _, p in rows)
