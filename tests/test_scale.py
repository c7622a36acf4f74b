"""What keeps a query's work in step with its tables: no line is shuffled to
join records, a landed line is parsed once, and staging's predicates compile."""

import re

import pytest

from tickerlake.plans import catalog
from tickerlake.session import METHOD_LIMIT, SESSION_DEFAULTS, tuned
from tickerlake.sources import csv, records

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def crossing(folder) -> str:
    """Files of many splits: records that end in the next split, one that goes
    on for many, one that is too long, and one that is never closed."""
    folder.mkdir()
    for name, tail in (("a", "end\n"), ("b", 'torn,"never\nclosed\n' * 3)):
        with open(folder / f"{name}.csv", "w") as f:
            f.write("\n  \nhead\n" + 'x,"1\n2",y\n' * 30 + 'long,"' + "line\n" * 20 + '",z\n' + 'longer,"' + "line\n" * 40 + '",z\n' + tail)
    return str(folder)


@pytest.mark.parametrize("size", ["24", "128m"])
def test_records_of_many_splits(spark, tmp_path, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        lines = records.numbered(records.read_lines(spark, crossing(tmp_path / "in")))
        got = records.broken_records(lines, max_lines=30).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    values = [r["value"] for r in got]
    assert values.count('x,"1\n2",y') == 60 and values.count('long,"' + "line\n" * 20 + '",z') == 2
    assert values.count('longer,"line') == 2 and values.count("line") == 78 and values.count('",z') == 2
    # Two of the three torn quotes open and close at the next one; what follows the last is left as lines.
    assert sum(v.startswith("torn") for v in values) >= 1 and values.count("end") == 1
    assert [r["value"] for r in got if r["head"]] == ["head", "head"]


def test_no_line_is_shuffled_to_join_records(spark, tmp_path):
    p = plan(records.records(records.read_lines(spark, crossing(tmp_path / "in"))))
    assert not re.search(r"hashpartitioning\(file#\d+, block#", p)      # was: every line, by split
    assert not re.search(r"hashpartitioning\(file#\d+, rblock#", p)     # was: every line, by record
    assert "SortMergeJoin" not in p


def test_a_landed_line_is_parsed_once(spark, tmp_path):
    for df in csv.quarantine_malformed(spark, crossing(tmp_path / "in")):
        assert plan(df).count("from_csv") == 1


def test_queries_tune_a_plain_session(spark):
    spark.conf.unset(METHOD_LIMIT)
    try:
        assert spark.conf.get(METHOD_LIMIT, None) is None
        catalog.QUERIES["moving_averages"](spark, SF_SMALL)
        assert spark.conf.get(METHOD_LIMIT) == SESSION_DEFAULTS[METHOD_LIMIT]
        spark.conf.set(METHOD_LIMIT, "4000")
        assert tuned(spark).conf.get(METHOD_LIMIT) == "4000"                # what was set stays
    finally:
        spark.conf.set(METHOD_LIMIT, SESSION_DEFAULTS[METHOD_LIMIT])
