import datetime as dt

import pytest

from quarry.operators import grid


def _activity(spark):
    rows = [("k1", "u", dt.datetime(2024, 1, 2, 0, 5)), ("k1", "u", dt.datetime(2024, 1, 2, 0, 6)),
            ("k1", "u", dt.datetime(2024, 1, 5, 23, 0)), ("k2", "v", dt.datetime(2024, 1, 9, 7, 0))]
    return spark.createDataFrame(rows, "g string, item string, ts timestamp_ntz")


def test_dense_grid_bounds_and_zero_fill(spark):
    counts = grid.day_hour_counts(_activity(spark), ["g", "item"])
    g = grid.dense_grid(counts, ["g", "item"]).collect()
    k1 = [r for r in g if r.g == "k1"]
    k2 = [r for r in g if r.g == "k2"]
    assert len(k1) == 4 * 24 and len(k2) == 24
    assert sum(r.n for r in k1) == 3 and sum(r.n for r in k2) == 1
    cell = {(r.day.day, r.hour): r.n for r in k1}
    assert cell[(2, 0)] == 2 and cell[(5, 23)] == 1 and cell[(3, 12)] == 0
    assert {r.hour for r in k1} == set(range(24))


def test_pivot_hours(spark):
    counts = grid.day_hour_counts(_activity(spark), ["g"])
    wide = grid.pivot_hours(grid.dense_grid(counts, ["g"]), ["g", "day"])
    cols = wide.columns
    assert cols[:2] == ["g", "day"] and cols[2] == "h00" and cols[-1] == "h23" and len(cols) == 26
    r = wide.filter("g = 'k1' AND day = DATE'2024-01-02'").first()
    assert r.h00 == 2 and r.h23 == 0


def test_wide_matrix_transpose(spark):
    wide = spark.createDataFrame([("w1", 1.0, 0.0, 2.0), ("w2", 0.0, 0.0, 0.0)],
                                 "word string, p1 double, p2 double, p3 double")
    long = grid.unpivot_wide(wide, "word")
    t = grid.transpose_long(long)
    got = sorted((r.row_label, r.column_label, r.n) for r in t.collect())
    assert got[0] == ("p1", "w1", 1.0) and len(got) == 6


def test_a_wrong_clock_fails_the_grid(spark):
    rows = [("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(9999, 12, 30)), ("b", dt.datetime(2024, 1, 1)), ("b", None)]
    counts = grid.day_hour_counts(spark.createDataFrame(rows, "g string, ts timestamp_ntz"), ["g"])
    with pytest.raises(Exception, match="more than 3660 days: 2024-01-01 to 9999-12-30"):
        grid.dense_grid(counts, ["g"]).collect()
    with pytest.raises(Exception, match="more than 2 days"):
        grid.dense_grid(grid.day_hour_counts(_activity(spark), ["g"]), ["g"], max_days=2).collect()
    assert grid.dense_grid(counts.where("g = 'b'"), ["g"]).count() == 24


def test_a_given_span_holds_for_every_key_and_cuts_nothing_off(spark):
    counts = grid.day_hour_counts(_activity(spark), ["g"])
    out = grid.dense_grid(counts, ["g"], span=(dt.date(2024, 1, 1), dt.date(2024, 1, 10)))
    assert {(r.g, r["count"]) for r in out.groupBy("g").count().collect()} == {("k1", 240), ("k2", 240)}
    assert out.agg({"n": "sum"}).first()[0] == 4
    with pytest.raises(Exception, match="outside the span"):
        grid.dense_grid(counts, ["g"], span=(dt.date(2024, 1, 3), dt.date(2024, 1, 10))).collect()
