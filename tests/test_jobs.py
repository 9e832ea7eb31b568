"""Invariants of the model jobs (the reference prints them; we assert them)."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.plans import papers, recommender
from quarry.sources import tables
from quarry.sources.readers import read_table
from quarry.sources.worktables import WorkTables


def test_genres_split_and_explode(spark):
    items = spark.createDataFrame([(1, "A|B"), (2, "A"), (3, ""), (4, None), (5, "A|A")],
                                  "item_id int, genres string")
    ratings = spark.createDataFrame([(u, i, 5.0) for u in (1, 2) for i in (1, 2, 3, 4, 5)],
                                    "user_id int, item_id int, rating double")
    got = {r.genre: r.n for r in recommender.top_genres(ratings, items).collect()}
    assert got == {"A": 3, "B": 1, "": 1}


def test_duplicate_policies(spark):
    r = spark.createDataFrame([(1, 1, 4.0, 1), (1, 1, 4.0, 1), (1, 2, 2.0, 1), (1, 2, 4.0, 2)],
                              "user_id int, item_id int, rating double, ts int")
    assert recommender.dedupe_ratings(r, "keep").count() == 4
    mean = {x.item_id: x.rating for x in recommender.dedupe_ratings(r, "mean").collect()}
    last = {x.item_id: x.rating for x in recommender.dedupe_ratings(r, "last").collect()}
    assert mean == {1: 4.0, 2: 3.0} and last == {1: 4.0, 2: 4.0}


def test_temporal_parts_invariants(spark):
    ratings = tables.ratings_table(read_table(spark, SF_SMALL, "lineitem"),
                                   read_table(spark, SF_SMALL, "orders"))
    parts = recommender.temporal_parts(ratings, (0.4, 0.8))
    n = ratings.count()
    for f in (0.4, 0.8):
        train, test = parts.train(f), parts.test(f)
        assert train.count() == int(n * f) and train.count() + test.count() == n
        assert train.agg(F.max("ts")).first()[0] <= test.agg(F.min("ts")).first()[0]


def test_paper_projection_invariants(spark):
    long = tables.count_matrix_long(read_table(spark, SF_SMALL, "embeddings"))
    long = long.select("row_label", F.col("col_pos").alias("column_label"), "n")
    coords, var, _ = papers.paper_projection(long)
    ev = [r.explained_variance for r in var.orderBy("component").collect()]
    assert len(ev) == 2 and 1 >= ev[0] >= ev[1] >= 0
    assert coords.count() == 64 and coords.select("row_label").distinct().count() == 64
    # centred data: coordinates average to zero
    m = coords.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1]) < 1e-9


def test_pca_loadings_sign_rule(spark):
    long = tables.count_matrix_long(read_table(spark, SF_SMALL, "embeddings"))
    long = long.select("row_label", F.col("col_pos").alias("column_label"), "n")
    rows = papers.paper_projection(long).loadings.collect()
    for comp in (1, 2):
        col = [r.loading for r in rows if r.component == comp]
        assert max(col, key=abs) > 0
        assert abs(sum(x * x for x in col) - 1.0) < 1e-9


def test_taste_clusters_invariants(spark):
    import __spark_entry__ as E
    sizes = E.queries()["taste_clusters"](spark, SF_SMALL).collect()
    for f in (0.4, 0.6, 0.8):
        rows = sorted((r for r in sizes if r.train_frac == f), key=lambda r: r.position)
        assert 1 <= len(rows) <= 5
        assert [r.position for r in rows] == list(range(1, len(rows) + 1))
        assert all(a.size >= b.size for a, b in zip(rows, rows[1:]))


def test_search_best_params_come_from_grid(spark):
    from quarry.plans import classifier
    ev = tables.collision_events(read_table(spark, SF_SMALL, "lineitem"))
    work = WorkTables(spark, "test")
    parts = classifier.search_parts(classifier.assemble(ev, tables.COLLISION_FEATURES, "event_key"), "event_key",
                                    work, sample_fraction=0.5)
    opts = {"maxDepth": [2, 4], "numTrees": [3, 6]}
    cv_model, res, best = classifier.search(parts, "forest", opts)
    assert best["maxDepth"] in opts["maxDepth"] and best["numTrees"] in opts["numTrees"]
    assert res.count() == 4
    assert len(set(round(m, 12) for m in cv_model.avgMetrics)) > 1


def test_ratings_split_fingerprint_invariants(spark):
    import __spark_entry__ as E
    rows = E.queries()["ratings_split"](spark, SF_SMALL).collect()
    by = {(r.train_frac, r.split): r for r in rows}
    total = by[(0.4, "train")].n + by[(0.4, "test")].n
    for f in (0.4, 0.6, 0.8):
        tr, te = by[(f, "train")], by[(f, "test")]
        assert tr.n == (total * int(round(f * 10000))) // 10000 and tr.n + te.n == total
        assert tr.last_ts <= te.first_ts
        assert tr.item_sum + te.item_sum == by[(0.4, "train")].item_sum + by[(0.4, "test")].item_sum


def test_als_fit_deletes_the_shuffle_files_of_its_iterations(spark):
    def files():
        return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()

    rows = [(u, i, float(1 + (u * i) % 5), t) for t, (u, i) in enumerate((u, i) for u in range(60) for i in range(20))]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")
    parts = recommender.temporal_parts(ratings, (0.8,))
    gone = time.time() + 20
    before = files()
    _, fitted = recommender.backtest(spark, None, {"x": {"rank": 3, "max_iter": 10, "reg_param": 0.1}}, (0.8,), parts=parts)
    # One iteration has 2 shuffles of 10 blocks; ten of them, kept, are more than 500 files.
    while (left := files() - before) > 250 and time.time() < gone:
        time.sleep(0.5)
    assert left <= 250 and fitted[("x", 0.8)].userFactors.count() == 48  # of the first 960 ratings
