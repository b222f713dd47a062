"""Log lines, number lines and record lines."""

from pyspark.sql import functions as F

from tallyfield.operators import logs
from tallyfield.operators.lines import parse_numbers, parse_records
from tallyfield.sources import local_rows

LOG = [
    'a.net [01:00:00:07 "GET /x.html" 200 1839',
    'a.net [01:10:00:07 "GET /y.html" 304 -',
    'b.net [02:00:00:01 "POST /form" 200 10',
    'b.net [02:00:00:02 "GET /x.html" 404 -',
    'c.net [31:23:59:59 "HEAD /x.html" 200 0',
]


def lines(spark, rows):
    return local_rows(spark, [[r] for r in rows], "line STRING")


def test_log_fields(spark):
    rows = logs.parse_access_log(lines(spark, LOG)).collect()
    assert tuple(rows[0]) == ("a.net", "[01:00:00:07", "01", "GET", "/x.html", "200", 1839, 6)
    assert [r.bytes for r in rows] == [1839, 0, 10, 0, 0]
    assert [r.day for r in rows] == ["01", "01", "02", "02", "31"]


def test_empty_transfers_count_in_the_truncated_mean(spark):
    parsed = logs.parse_access_log(lines(spark, LOG))
    means = {r.method: r.avg_bytes for r in logs.mean_bytes(parsed).collect()}
    assert means == {"GET": 1839 // 3, "POST": 10, "HEAD": 0}


def test_status_sets(spark):
    parsed = logs.parse_access_log(lines(spark, LOG + ['d.net [01:00:00:00 "GET /z" odd 1']))
    rows = {r.method: (r.statuses, r.n_other) for r in logs.status_sets(parsed).collect()}
    assert rows == {"GET": ("200,304,404,odd", 1), "POST": ("200", 0), "HEAD": ("200", 0)}


def test_malformed_lines_parse_to_nulls_and_are_reported(spark):
    bad = ["", "only three tokens", 'a [01:00:00:00 "GET /a b" 200 5', 'a [01:00:00:00 "GET /a" 200 x']
    parsed = logs.parse_access_log(lines(spark, LOG + bad))
    assert parsed.count() == len(LOG) + len(bad)
    found = {(r.n_tokens, r.bytes) for r in logs.malformed(parsed).collect()}
    assert found == {(1, None), (3, None), (7, 5), (6, None)}


def test_number_lines(spark):
    rows = parse_numbers(lines(spark, ["1.5 2", "3 x", "4", ""]), ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [(1.5, 2.0), (3.0, None), (4.0, None), (None, None)]


def test_record_lines_keep_data_that_holds_a_column_name(spark):
    header = "carat\tcut\tprice"
    rows = parse_records(
        lines(spark, [header, "0.5\tIdeal\t700", "1.0\tone carat\t900"]),
        "carat DOUBLE, cut STRING, price INT", header=header).orderBy("price").collect()
    assert [tuple(r) for r in rows] == [(0.5, "Ideal", 700), (1.0, "one carat", 900)]


def test_parsing_stays_in_the_jvm(spark):
    df = logs.mean_bytes(logs.parse_access_log(spark.range(5).select(F.lit(LOG[0]).alias("line"))))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_parsing_can_fail_loudly(spark):
    import pytest

    from tallyfield.operators.lines import parse_numbers, parse_records
    good, bad = lines(spark, ["1 2.5"]), lines(spark, ["1 x"])
    assert tuple(parse_numbers(good, ["a", "b"], fail=True).first()) == (1.0, 2.5)
    for frame in (parse_numbers(bad, ["a", "b"], fail=True), parse_records(bad, "a INT, b INT", sep=" ", fail=True)):
        with pytest.raises(Exception, match="field 2 does not parse: x"):
            frame.collect()
