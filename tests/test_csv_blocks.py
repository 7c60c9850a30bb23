"""CSV files read by blocks against a whole-file parse."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pantry.sources import csv_blocks as B

CELLS = ["", "a", "1.5", "two words", 'say "hi"', '"', '""', "a,b", ",", "line\nbreak", "\n", "\n\n", '",\n"', "é\nü", "x" * 300, '\n"quoted\nline",\n']


def schema(*names):
    return StructType([StructField(n, StringType()) for n in names])


def parsed(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    names = [c.strip().lower() for c in rows[0]]
    return [dict(zip(names, r)) for r in rows[1:]]  # noqa: B905


def written(rng, names, n, quoting):
    out = io.StringIO(newline="")
    w = csv.writer(out, quoting=quoting, lineterminator="\n")
    w.writerow(names)
    for i in range(n):
        w.writerow([str(i), *rng.choices(CELLS, k=len(names) - 1)])
    return out.getvalue()


@pytest.fixture
def blocks_of(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("block", [397, 1009, 1 << 20])
def test_blocks_cut_anywhere(spark, tmp_path, blocks_of, block):
    blocks_of(block)
    rng, want = random.Random(block), []
    folder = tmp_path / "a folder, 100%"
    folder.mkdir()
    heads = [["Id", " B ", "c", "D"], ["id", "d", "c", "b"], ["ID", "x", "b"]]
    for i, (quoting, head) in enumerate([(csv.QUOTE_MINIMAL, heads[0]), (csv.QUOTE_ALL, heads[1]), (csv.QUOTE_MINIMAL, heads[2]), (csv.QUOTE_MINIMAL, heads[0])]):
        text = written(rng, head, 150, quoting)
        (folder / f"x {i}%20.csv").write_text(("\ufeff" if i == 2 else "") + text, newline="")
        want += [tuple(r.get(k) or None for k in ("id", "b", "c", "d")) for r in parsed(text)]
    (folder / "empty.csv").write_text("")
    (folder / "header.csv").write_text("id,b\n")
    rows, headers = B.records(spark, str(folder))
    assert len(headers) == 4
    if block < 1000:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
    got = B.read_csv(spark, str(folder), schema("id", "b", "c", "d"))
    got = [tuple(c or None for c in r) for r in got.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quotes_inside_plain_fields_and_open_ends(spark, tmp_path, blocks_of):
    blocks_of(64)
    text = 'id,name,n\n1,5" pipe,2\n2,a"b"c,3\n\n3,"x"y,4\r\n4,short\n5,long,1,2,3\n6,"open, to\nthe end,\n' + "z\n" * 100
    (tmp_path / "a.csv").write_text(text, newline="")
    got = {r["id"]: tuple(r)[1:] for r in B.read_csv(spark, str(tmp_path / "a.csv"), schema("id", "name", "n", "none")).collect()}
    assert got["1"] == ('5" pipe', "2", None) and got["2"] == ('a"b"c', "3", None)
    assert got["3"][1] == "4" and got["4"] == ("short", None, None) and got["5"] == ("long", "1", None)
    assert sorted(got) == list("123456")


def test_typed_cells_and_no_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Recipe_ID,minutes\n1,x\n2,7\n")
    frame = B.read_csv(spark, str(tmp_path), StructType.fromDDL("recipe_id int, minutes int, name string"))
    assert sorted(map(tuple, frame.collect())) == [(1, None, None), (2, 7, None)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert B.read_csv(spark, str(tmp_path / "none"), schema("a")).collect() == []


def test_states_follow_any_cut():
    rng = random.Random(3)
    for _ in range(300):
        text = written(rng, ["a", "b", "c"], 3, rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        inside, n = False, 0
        for line in text.removesuffix("\n").split("\n"):
            inside = B.ends_inside(line, inside)
            n += not inside
        assert not inside and n == 4 + sum(not r for r in csv.reader(io.StringIO(text, newline="")))


def test_scan_reads_no_more_than_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1\n")
    plan = B.records(spark, str(tmp_path))[0].select(F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Union")[0] and plan.count("FileScan text") == 1
