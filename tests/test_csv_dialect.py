"""CSV sources against ``csv.DictReader``."""

import csv
import random

import pytest
from pyspark.sql import types as T

from forgeline.sources.files import read_csv_by_name

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("note", T.StringType()), T.StructField("minutes", T.LongType())])


def test_doubled_quotes_and_quoted_line_ends(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note,minutes\n1,"5"" bolt, hex",3\n2,"two\nlines",4\n3,plain,5\n')
    with open(path, newline="") as f:
        want = sorted((r["id"], r["note"], int(r["minutes"])) for r in csv.DictReader(f))
    got = read_csv_by_name(spark, str(path), SCHEMA, source_order=False).collect()
    assert sorted(map(tuple, got)) == want


def test_files_that_order_columns_differently_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,minutes\n1,x,3\n")
    (tmp_path / "b.csv").write_text("note,id,minutes\ny,2,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_by_name(spark, str(tmp_path), SCHEMA, source_order=False).collect()


@pytest.fixture()
def small_splits(spark):
    """Splits of some hundred bytes, so that records lie across them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def expected(path):
    with open(path, newline="", encoding="utf-8") as f:
        return [(r["id"], r["note"] or None, int(r["minutes"])) for r in csv.DictReader(f)]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_records_across_many_splits_in_row_order(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    path = tmp_path / "many.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "note", "minutes"])
        for i in range(300):
            note = "".join(rng.choice(["a", '"', ",", end, "é ", "word "]) for _ in range(rng.randrange(0, 25)))
            if seed == 3 and i == 150:
                note = "long\n" * 400  # over several splits
            w.writerow([i, note, rng.randrange(99)])
    df = read_csv_by_name(spark, str(path), SCHEMA)
    assert spark.read.text(str(path), lineSep="\n").rdd.getNumPartitions() > 10
    got = df.orderBy("_src_offset", "_row_seq").select("id", "note", "minutes").collect()
    assert list(map(tuple, got)) == expected(path)
    assert df.select("_src_offset", "_row_seq").distinct().count() == 300


def test_files_without_quoted_line_ends_are_read_in_one_pass_of_lines(spark, tmp_path, small_splits):
    path = tmp_path / "plain.csv"
    path.write_text("id,note,minutes\n" + "".join(f'{i},"x,{i}",{i}\n\n' for i in range(200)))
    df = read_csv_by_name(spark, str(path), SCHEMA, source_order=False)
    assert sorted(map(tuple, df.collect())) == sorted(expected(path))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_file_that_ends_inside_a_field_is_refused(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id,note,minutes\n1,x,3\n2,"open,4\n' + "3,y,5\n" * 200)
    with pytest.raises(ValueError, match="not closed"):
        read_csv_by_name(spark, str(tmp_path / "a.csv"), SCHEMA)


def test_a_header_alone_an_empty_file_and_a_mark(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,note,minutes\n")
    assert read_csv_by_name(spark, str(tmp_path / "h.csv"), SCHEMA).count() == 0
    (tmp_path / "e.csv").write_text("")
    assert read_csv_by_name(spark, str(tmp_path / "e.csv"), SCHEMA).count() == 0
    (tmp_path / "b.csv").write_text("\ufeffid,note,minutes\r\n7,\"\",1", encoding="utf-8")
    assert [tuple(r) for r in read_csv_by_name(spark, str(tmp_path / "b.csv"), SCHEMA, source_order=False).collect()] == [("7", None, 1)]
    assert read_csv_by_name(spark, str(tmp_path / "none.csv"), SCHEMA) is None
