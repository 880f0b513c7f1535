import csv
import json
import random

import pytest

from conftest import rows_of
from titleprep.sources import ranges, readers

TEXTS = ["plain", 'say "hi"', "a,b", "line\nbreak", "\n", '"', '""\n"', "", None, " x ", "é\r\nü", "back\\slash", "o" * 300 + "\n" * 7]


@pytest.fixture
def small_ranges(spark):
    """Tasks get 2,000 bytes of a file."""
    for key, value in (("maxPartitionBytes", "2000"), ("openCostInBytes", "0")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def write(path, rows, header=("id", "a", "b"), end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def some(seed, n):
    rng = random.Random(seed)
    return [(str(i), rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("keep_empty", [True, False])
def test_csv_by_ranges_equals_one_task(spark, tmp_path, small_ranges, end, keep_empty):
    rows = some(1, 400)
    write(tmp_path / "x.csv", rows, end=end)
    # a field longer than several ranges
    write(tmp_path / "y.csv", [("long\n" * 3_000, "7b", "z"), ("q", "8b", None)], header=("a", "id", "b"), end=end)
    cut = readers.read_csv(spark, str(tmp_path), keep_empty=keep_empty)
    assert cut.rdd.getNumPartitions() > 8
    expected = [*rows, ("7b", "long\n" * 3_000, "z"), ("8b", "q", None)]
    assert rows_of(cut) == sorted(((a or None, b or None, c or None) for a, b, c in expected), key=repr)
    if end == "\n":
        whole = readers.read_csv(spark, str(tmp_path), keep_empty=keep_empty, by_ranges=False)
        assert cut.columns == whole.columns and rows_of(cut) == rows_of(whole)


def test_files_without_line_breaks_inside_fields(spark, tmp_path, small_ranges):
    write(tmp_path / "x.csv", [(str(i), "x" * 40, 'a "quote"') for i in range(300)], end="\n")
    rows = readers.read_csv(spark, f"{tmp_path}/x.csv")
    assert rows.count() == 300 and rows.where("a = repeat('x', 40) and b = 'a \"quote\"'").count() == 300


@pytest.mark.parametrize(
    "bad", ['1,"open,x\n', '1,5" x,y\n2,6" z,y\n', "1,only\n", "1,a,b,c\n", '1,"a\nb",c,d\n'],
)
@pytest.mark.parametrize("action", ["count", "collect"])
def test_broken_records_are_errors(spark, tmp_path, bad, action):
    (tmp_path / "x.csv").write_text("id,a,b\n1,x,y\n" + bad + "3,x,y\n")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        df = readers.read_csv(spark, f"{tmp_path}/x.csv", by_ranges=True)
        df.select("id").collect() if action == "collect" else df.count()


def test_blank_lines_and_quoted_header(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'\n\n"i\nd",a,,a\n1,x,y,z\n\n2,x,y,z\n')
    for by_ranges in (True, False):
        rows = readers.read_csv(spark, f"{tmp_path}/x.csv", by_ranges=by_ranges)
        assert rows.columns == ["i\nd", "a1", "_c2", "a3"]
        assert rows_of(rows) == [("1", "x", "y", "z"), ("2", "x", "y", "z")]


@pytest.mark.parametrize(
    "header", ["a,b", "a,,A", '"a ""x""",b', "﻿a,b", "a,b\r", " a , b", '"x,y",_c0,', "é,ü"],
)
def test_header_names_are_those_of_spark(spark, tmp_path, header):
    (tmp_path / "x.csv").write_bytes(f"{header}\n1,2\n".encode())
    expected = spark.read.csv(f"{tmp_path}/x.csv", header=True, quote='"', escape='"', multiLine=True).columns
    assert list(next(iter(readers._by_header(spark, f"{tmp_path}/x.csv"))).columns) == [c.rstrip("\r") for c in expected]


def test_compressed_files(spark, tmp_path):
    spark.createDataFrame(some(2, 50), "id string, a string, b string").coalesce(1).write.csv(
        f"{tmp_path}/z", header=True, compression="gzip", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    assert readers.read_csv(spark, f"{tmp_path}/z").count() == 50


def test_headers_of_many_files_take_no_jobs(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"part-{i}.csv").write_text("a,b\n1,2\n" if i % 2 else "b,a\n2,1\n")
    tracker, group = spark.sparkContext.statusTracker(), "many files"
    spark.sparkContext.setJobGroup(group, group)
    try:
        rows = readers.read_csv(spark, f"{tmp_path}/part-*.csv")
        jobs = len(tracker.getJobIdsForGroup(group))
        assert rows.where("a = 1 and b = 2").count() == 300
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # listing alone: it does not grow with the number of files
    assert jobs <= 4


def document(columns, indent=None):
    return json.dumps({name: dict(members) for name, members in columns.items()}, indent=indent, ensure_ascii=False)


VALUES = ["nm1", None, 'q"uote', "a,b", "{", "}", "\\", '\\"', "", "x: y", "é\n", "[1,2]"]


@pytest.mark.parametrize("indent", [None, 2])
def test_columnar_json_by_ranges(spark, tmp_path, small_ranges, indent):
    rng = random.Random(3)
    rows = [(f"tt{i}", rng.choice(VALUES)) for i in range(500)]
    columns = {
        "movie": [(str(i), m) for i, (m, _) in enumerate(rows)],
        "n,{o": [("0", 1.5), ("1", True)],
        "none": [],
        "director": [(f"k{i},", d) for i, (_, d) in enumerate(rows)],
    }
    (tmp_path / "d.json").write_text(document(columns, indent), encoding="utf-8")
    (tmp_path / "e.json").write_text(document({"director": [("x", "d")], "movie": [("y", "m")]}))
    found = readers.read_columnar_json(spark, str(tmp_path), "movie", "director")
    assert rows_of(found) == sorted([*rows, ("m", "d")], key=repr)
    one = readers.read_columnar_json(spark, f"{tmp_path}/d.json", "n,{o", by_ranges=True)
    assert rows_of(one) == [("1.5",), ("true",)]


@pytest.mark.parametrize(
    "text",
    ['{"movie": {"0": "tt1"', '{"movie": {"0": "a"}, "director": nothing}', '{"movie": {"0": {"x": 1}}, "director": {"0": "b"}}',
     '{"movie": {"0": "a"}, "director": {"0": "b"}', '{"movie": {"0": "a}, "director": {"0": "b"}}', "[]"],
)
def test_broken_documents_are_errors(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="[Mm]alformed|MALFORMED"):
        readers.read_columnar_json(spark, f"{tmp_path}/d.json", "movie", "director", by_ranges=True).collect()


def test_uneven_and_empty_columns(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"movie": {"0": "a"}, "director": {}}')
    with pytest.raises(Exception, match="differ in length"):
        readers.read_columnar_json(spark, f"{tmp_path}/d.json", "movie", "director", by_ranges=True).collect()
    (tmp_path / "d.json").write_text('{"movie": {}, "director": { } }')
    assert readers.read_columnar_json(spark, f"{tmp_path}/d.json", "movie", "director", by_ranges=True).count() == 0


def test_ranges_are_many_tasks(spark, tmp_path, small_ranges):
    write(tmp_path / "x.csv", some(5, 500))
    found = ranges.records(spark, [f"{tmp_path}/x.csv"], ranges.CSV)
    assert found.select("start").distinct().count() > 5
