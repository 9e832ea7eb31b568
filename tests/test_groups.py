from pyspark.sql import functions as F

from quarry.operators import groups


def _host_counts(spark):
    rows = []
    # group A: 12 hosts, counts 20..9 except a tie at places 9/10 (both 12)
    counts = [20, 19, 18, 17, 16, 15, 14, 13, 12, 12, 11, 10]
    for i, c in enumerate(counts):
        rows += [("A", f"a{i:02d}")] * c
    rows += [("B", f"b{i}") for i in range(9) for _ in range(i + 1)]   # exactly 9 hosts
    rows += [("C", f"c{i}") for i in range(3)]                          # 3 hosts
    return spark.createDataFrame(rows, "g string, host string")


def test_top_n_ties_broken_by_item(spark):
    top = groups.top_n(_host_counts(spark), "g", "host", 9).filter("g = 'A'")
    got = [r.host for r in top.orderBy("rank").collect()]
    assert got[-1] == "a08"  # a08 and a09 tie at 12; the smaller item wins
    assert len(got) == 9


def test_top_n_vs_rest_shapes(spark):
    out = groups.top_n_vs_rest(_host_counts(spark), "g", "host", 9)
    by_g = {}
    for r in out.collect():
        by_g.setdefault(r.g, []).append(r)
    assert len(by_g["A"]) == 10 and len(by_g["B"]) == 9 and len(by_g["C"]) == 3
    other = [r for r in by_g["A"] if r.host == "Other"][0]
    assert other.rank == 10 and other.n == 12 + 11 + 10
    assert abs(sum(r.pct for r in by_g["A"]) - 100.0) <= 0.05
    assert sum(r.n for r in by_g["A"]) == sum([20, 19, 18, 17, 16, 15, 14, 13, 12, 12, 11, 10])


def test_window_group_limit_is_planned(spark):
    top = groups.top_n(_host_counts(spark), "g", "host", 9)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_distinct_and_distribution(spark):
    df = _host_counts(spark)
    d = {r.g: r.n_distinct for r in groups.distinct_counts(df, "g", "host").collect()}
    assert d == {"A": 12, "B": 9, "C": 3}
    dist = groups.class_distribution(df, "g").collect()
    assert abs(sum(r.share for r in dist) - 1.0) < 1e-12
    assert sum(r.n for r in dist) == df.count()
    approx = groups.distinct_counts(df, "g", "host", approximate=True).agg(F.sum("n_distinct"))
    assert approx.first()[0] == 24


def test_null_group_is_kept(spark):
    rows = [(None, f"h{i}") for i in range(12) for _ in range(i + 1)] + [("x", "h0")]
    df = spark.createDataFrame(rows, "g string, host string")
    out = groups.top_n_vs_rest(df, "g", "host", 9).collect()
    assert len([r for r in out if r.g is None]) == 10
    assert sum(r.n for r in out) == len(rows)
