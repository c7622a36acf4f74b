"""Quoted line breaks: the splitter against a plain reader of characters, at
any size of the splits, and through S1, S2, S3, X4 and X5."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickerlake.sources import csv, records
from tickerlake.sources.tables import LOAD, read_table
from tickerlake.streaming import refresh

HEAD = "symbol,date,open,high,low,close,volume,ingestion_timestamp,source_system,pipeline_run_id"
BAR = "{0},2026-01-0{1},10.00,12.00,9.00,11.00,100,2026-01-05T00:00:00.000000,{2},run"


def plain_records(text: str) -> list[str]:
    """Character by character; a field left open at the end frees its lines."""
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    out, i = [], 0
    while i < len(lines):
        j, state = i, ends_open(lines[i], False)
        while state and j + 1 < len(lines):
            j += 1
            state = ends_open(lines[j], True)
        if state:                                   # never closed
            out += lines[i:]
            break
        out.append("\n".join(lines[i:j + 1]))
        i = j + 1
    return out


def ends_open(line: str, inside: bool) -> bool:
    k, start = 0, not inside
    while k < len(line):
        if inside:
            if line[k] == '"':
                if line[k + 1:k + 2] == '"':
                    k += 1
                else:
                    inside = False
        elif line[k] == ",":
            start = True
            k += 1
            continue
        elif line[k] == '"' and start:
            inside = True
        start = False
        k += 1
    return inside


def test_records_equal_a_plain_reader(spark, tmp_path):
    rng = random.Random(5)
    want = []
    for n in range(12):
        text = "".join(rng.choices(['"', '""', ",", "a", "b", "\n"], weights=[3, 1, 4, 3, 3, 3], k=rng.randint(20, 160)))
        with open(tmp_path / f"{n}.csv", "w", newline="") as f:
            f.write(text)
        want += plain_records(text)
    for size in ("128m", "48"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = [r["value"] for r in records.records(records.read_lines(spark, str(tmp_path))).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(got) == sorted(want), size


def test_a_long_record_is_left_as_its_lines(spark, tmp_path):
    with open(tmp_path / "a.csv", "w") as f:
        f.write('x,"1\n2\n3\n4",y\nz\n')
    lines = records.read_lines(spark, str(tmp_path))
    assert sorted(r["value"] for r in records.records(lines).collect()) == ['x,"1\n2\n3\n4",y', "z"]
    assert sorted(r["value"] for r in records.records(lines, max_lines=3).collect()) == ["2", "3", '4",y', 'x,"1', "z"]


def landed(folder) -> str:
    folder.mkdir()
    with open(folder / "broken.csv", "w", newline="") as f:
        f.write("\r\n".join([HEAD, BAR.format("A", 1, '"two\r\nlines, and ""quotes"""'), BAR.format("A", 2, "one"), 'torn,"a\nb"', ""]))
    with open(folder / "plain.csv", "w") as f:
        f.write("\n".join([HEAD, BAR.format("B", 1, "one"), ""]))
    return str(folder)


def test_quoted_breaks_through_readers_and_streams(spark, tmp_path):
    landing = landed(tmp_path / "landing")
    want = {("A", dt.date(2026, 1, 1), 'two\nlines, and "quotes"'), ("A", dt.date(2026, 1, 2), "one"), ("B", dt.date(2026, 1, 1), "one")}

    def of(df):
        return {(r["symbol"], r["date"], r["source_system"].replace("\r\n", "\n")) for r in df.filter("date is not null").collect()}

    good, bad = csv.quarantine_malformed(spark, landing)
    assert of(good) == want and good.count() == 3
    assert [(r["raw_line"], r["reasons"]) for r in bad.collect()] == [('torn,"a\nb"', ["malformed"])]
    assert of(csv.read_bars_csv(spark, landing)) == want
    assert csv.read_bars_csv(spark, landing).count() == 4
    assert csv.read_bars_csv(spark, landing, mode="DROPMALFORMED").count() == 3
    with pytest.raises(Exception, match="malformed"):
        csv.read_bars_csv(spark, landing, mode="FAILFAST").collect()

    bronze, staged = str(tmp_path / "bronze"), str(tmp_path / "staged")
    assert refresh.ingest_new_files(spark, landing, bronze, str(tmp_path / "c1")) == 3
    assert of(read_table(spark, bronze).drop(LOAD)) == want
    refresh.stream_upsert(spark, landing, staged, str(tmp_path / "c2"))
    assert read_table(spark, staged).count() == 3
    assert [r["raw_line"] for r in read_table(spark, staged + "_quarantine").collect()] == ['torn,"a\nb"']


def test_quoted_breaks_survive_an_export(spark, tmp_path):
    df = spark.createDataFrame([("A", "x\ny"), ("B", 'say "hi",\n\nthen'), ("C", "plain")], "symbol string, note string").repartition(2)
    path = str(tmp_path / "out")
    assert csv.write_bars_csv(df, path) == 3
    back = csv.read_bars_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.filter(F.col("note").contains("\n")).count() == 2
