from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import has_keyword
from tallyloom.functions.times import parse_creation_time
from tallyloom.operators import events as ev
from tallyloom.sources.tsv import (
    checked_event_lines, read_checked_events, read_event_tsv, split_event_lines,
)

LINES = [
    "1\tann\tSun Jan 23 00:00:00 +0000 2011\tfrom EgYpt",
    "2\tbob\tSun Jan 23 10:59:59 +0000 2011\tplain",
    "3\tcat",
    "4\tdan\tSun Jan 23 02:00:00 +0000 2011\ta\textra field",
    "5\teve\tSun Jan 23 23:30:00 -0100 2011\tsays \"cairo",
    "6\tfay\tWed Feb 09 00:00:00 +0000 2011\tupper bound",
    "7\tgil\tSat Jan 22 00:00:00 +0000 2011\tlower bound",
    "8\thal\tno time at all\tegypt",
    "9\tida\tTue Feb 08 23:59:59 +0000 2011",
]


@pytest.fixture(scope="module", params=["file", "lines"])
def table(request, spark, tmp_path_factory):
    if request.param == "lines":
        return split_event_lines(spark.createDataFrame([(x,) for x in LINES], "line string"))
    path = tmp_path_factory.mktemp("tsv") / "events.tsv"
    path.write_text("\n".join(LINES) + "\n")
    return read_event_tsv(spark, str(path))


def test_fields_and_times(table):
    rows = {r.id: r for r in table.collect()}
    assert len(rows) == 9
    assert rows[3].creation_time is None and rows[3].time is None
    assert rows[4].text == "a"
    assert rows[5].text == 'says "cairo' and rows[5].time == datetime(2011, 1, 24, 0, 30)
    assert rows[8].time is None
    assert rows[9].text is None and rows[9].time == datetime(2011, 2, 8, 23, 59, 59)


def test_padded_hours_in_order_of_time(table):
    found = ev.hourly_counts(ev.in_range(table, "2011-01-22", "2011-02-09"))
    assert [tuple(r) for r in found.collect()] == [
        ("01/23 00", 1), ("01/23 02", 1), ("01/23 10", 1), ("01/24 00", 1), ("02/08 23", 1)
    ]


def test_unpadded_hours_in_order_of_text(table):
    found = [tuple(r) for r in ev.hourly_counts_unpadded(table).collect()]
    assert found == [("1/22 0", 1), ("1/23 0", 1), ("1/23 10", 1), ("1/23 2", 1), ("1/24 0", 1),
                     ("2/8 23", 1), ("2/9 0", 1)]


def test_keyword_hours(table):
    found = ev.hourly_counts(ev.with_keyword(table, ["egypt", "cairo"]))
    assert [tuple(r) for r in found.collect()] == [("01/23 00", 1), ("01/24 00", 1)]


def test_a_keyword_is_no_pattern(spark):
    row = spark.createDataFrame([("a.c", "abc")], "x string, y string")
    found = row.select(has_keyword(F.col("x"), ["A.C"]), has_keyword(F.col("y"), ["a.c"])).first()
    assert tuple(found) == (True, False)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    lines = spark.createDataFrame(
        [("Sun Mar 13 02:30:00 +0000 2011",), ("Sun Nov 06 05:30:00 +0000 2011",),
         ("Sun Nov 06 06:30:00 +0000 2011",)], "c string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = lines.select(parse_creation_time(F.col("c")).alias("time"))
        assert [r.time for r in parsed.collect()] == [
            datetime(2011, 3, 13, 2, 30), datetime(2011, 11, 6, 5, 30), datetime(2011, 11, 6, 6, 30)]
        assert [tuple(r) for r in ev.hourly_counts(parsed).collect()] == [
            ("03/13 02", 1), ("11/06 05", 1), ("11/06 06", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_same_hour_of_two_years(spark):
    times = spark.createDataFrame([(datetime(2010, 1, 2, 3),), (datetime(2011, 1, 2, 3),)], "time timestamp_ntz")
    assert [tuple(r) for r in ev.hourly_counts(times).collect()] == [("01/02 03", 1), ("01/02 03", 1)]
    assert [tuple(r) for r in ev.hourly_counts_unpadded(times).collect()] == [("1/2 3", 2)]


REJECTED = {
    "": "empty line", "  ": "empty line", "3\tcat": "too few fields", LINES[8]: "too few fields",
    LINES[3]: "too many fields", "x\tu\t" + LINES[0].split("\t")[2] + "\tt": "id is no number",
    LINES[7]: "no valid time",
}


def test_every_line_is_kept_or_rejected_with_its_reason(spark, tmp_path):
    sound = [x for x in LINES if x not in REJECTED]
    (tmp_path / "a.tsv").write_text("\n".join([*sound, *REJECTED, *sound]) + "\n")
    kept, rejected = read_checked_events(spark, str(tmp_path / "a.tsv"), str(tmp_path / "stored"))
    assert sorted(r.id for r in kept.collect()) == sorted(2 * [int(x.split("\t")[0]) for x in sound])
    assert all(r.time and r.user_name for r in kept.collect())
    assert {r.line: r.reason for r in rejected.collect()} == REJECTED and rejected.count() == len(REJECTED)


def test_lines_may_end_before_the_text(spark):
    lines = spark.createDataFrame([(x,) for x in [*LINES, None]], "line string")
    found = {r.line: r.reason for r in checked_event_lines(lines, fields=3).collect()}
    assert found[LINES[8]] is None and found[LINES[2]] == "too few fields" and found[None] == "empty line"
    assert found[LINES[7]] == "no valid time"
