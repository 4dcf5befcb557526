"""Quoted CSV in splits: the same rows as the reader that takes a file in one task."""

import random

import pytest
from pyspark.errors import PySparkException

from tillwork.sources import quoted_csv
from tillwork.sources.quoted_csv import read_quoted_csv, records

SCHEMA = "id long, note string, price double, last string"


def by_one_task(spark, path, schema=SCHEMA):
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"', enforceSchema=False).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    changed = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(folder, name, seed, number, end="\n"):
    r = random.Random(seed)
    fields = ["", "plain", '"a, b"', '"two\nlines"', '"say ""so"""', '"""\n"""', '"\n\n\n"', '""', " pad ", "é 中", '"' + "x\n" * 60 + '"', '"crlf\r\nin"']
    lines = ["id,note,price,last"]
    for i in range(number):
        lines.append(f"{i},{r.choice(fields)},{r.choice(['', '1.5', '-2', 'no'])},{r.choice(fields)}")
        if r.random() < 0.02:
            lines.append("")
    (folder / name).write_bytes((end.join(lines) + r.choice(["", end])).encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task(spark, tmp_path, small_splits, end):
    for k in range(3):
        written(tmp_path, f"{k}.csv", k, 1500, end)
    path = str(tmp_path)
    blocks = spark.read.text(path).selectExpr("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    assert blocks > 20
    found = read_quoted_csv(spark, path, SCHEMA)
    assert found.columns == ["id", "note", "price", "last"] and rows(found) == rows(by_one_task(spark, path))
    assert found.count() == 4500
    assert records(spark, path).where("first").count() == 3


def test_every_place_of_a_split_inside_a_record(spark, tmp_path, small_splits):
    text = "id,note\n" + "".join(f'{i},"{"y" * (i % 7)}\n""q""\n,"\n' for i in range(200))
    (tmp_path / "a.csv").write_text(text)
    schema = "id long, note string"
    for size in (7, 64, 501, 999):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        found = rows(read_quoted_csv(spark, str(tmp_path / "a.csv"), schema))
        assert found == sorted([(i, f'{"y" * (i % 7)}\n"q"\n,') for i in range(200)], key=str)


def test_only_ends_of_splits_are_shuffled(spark, tmp_path, small_splits):
    written(tmp_path, "a.csv", 1, 2000)
    found = records(spark, str(tmp_path / "a.csv"))
    assert found.count() == 2001
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT (piece" in plan and plan.count("Window") == 1
    blocks = spark.read.text(str(tmp_path)).selectExpr("_metadata.file_block_start").distinct().count()
    lines = quoted_csv._lines(spark, str(tmp_path / "a.csv"))
    pieces = lines.mapInArrow(quoted_csv._assembler(quoted_csv._open_splits(lines, '"')[0], '"'), quoted_csv._RECORDS).where("piece > 0")
    assert blocks > 20 and pieces.count() <= 2 * blocks


def test_wrong_header_empty_file_and_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,other\n1,x\n")
    with pytest.raises(PySparkException, match="the header is not id,note"):
        read_quoted_csv(spark, str(tmp_path / "a.csv"), "id long, note string").collect()
    (tmp_path / "b.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path / "b.csv"), SCHEMA).collect() == []
    (tmp_path / "c.csv").write_text('1,"x\ny"\n')
    assert rows(read_quoted_csv(spark, str(tmp_path / "c.csv"), "id long, note string", header=False)) == [(1, "x\ny")]
