"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (whole tables, no id subsets) and runs
one job of this package.  The stand-ins for the reference's inputs are in
:mod:`quarry.sources.tables`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import round_sig, suffix_label
from quarry.operators import features, grid, groups, metrics, models, sampling, selection
from quarry.operators.ranking import numbered
from quarry.operators.selection import union_all
from quarry.operators.split_gains import split_gains
from quarry.plans import classifier, claims, logs, papers, recommender
from quarry.sources import tables
from quarry.sources.readers import read_table
from quarry.sources.worktables import WorkTables

# Groups of interest for the per-group counts (the stand-in for the three
# countries of interest among all host countries).
TYPES_OF_INTEREST = ["click", "purchase", "signup"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def q_group_counts(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return groups.group_counts(ev, "event_type", "n_requests",
                               only={"event_type": TYPES_OF_INTEREST})


def q_group_distinct(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return groups.distinct_counts(ev, "event_type", "user_id", "n_users")


def q_class_distribution(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return groups.class_distribution(orders, "o_orderstatus")


def q_top_n_per_group(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return groups.top_n(ev, "event_type", "user_id", 9, "n_requests")


def q_top_n_vs_rest(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return groups.top_n_vs_rest(ev, "event_type", "user_id", 9, count_col="n_requests",
                                item_label_col="host")


def q_top_items(spark, sf_dir):
    """The ten users with most events of all."""
    counts = groups.group_counts(_t(spark, sf_dir, "events"), "user_id", "n_requests")
    return groups.top_k(counts, [F.col("n_requests").desc(), F.col("user_id")], 10)


def q_chart_table(spark, sf_dir):
    """Requests per type and hour in the order in which a chart draws them."""
    counts = grid.day_hour_counts(_t(spark, sf_dir, "events"), ["event_type"])
    by_hour = counts.groupBy("event_type", "hour").agg(F.sum("n").alias("n"))
    order = [F.col("event_type"), F.col("n").desc(), F.col("hour")]
    return numbered(by_hour, order, "position", WorkTables(spark, "chart")).orderBy("position")


# Fixed values of this catalogue: page host suffix -> class.
PAGE_SUFFIXES = {".com": "commercial", ".net": "network", ".org": "organisation"}
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


# Fixed values of this catalogue: host suffix -> country (hosts end in the event type).
HOST_COUNTRIES = {".click": "Germany", ".purchase": "Canada", ".signup": "Singapore"}


def q_log_parse(spark, sf_dir):
    lines = tables.access_log_lines(_t(spark, sf_dir, "events"))
    return logs.tag_country(logs.parse_access_log(lines), HOST_COUNTRIES)


def q_suffix_class(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    host = F.regexp_extract("url", URL_HOST, 1)
    labelled = pages.select(suffix_label(host, PAGE_SUFFIXES).alias("host_class"))
    return groups.group_counts(labelled, "host_class", "n_pages")


def q_calendar_parts(spark, sf_dir):
    lines = tables.access_log_lines(_t(spark, sf_dir, "events"))
    parsed = logs.parse_access_log(lines, keep_malformed=False)
    return grid.day_hour_counts(parsed, [], "ts", "n")


def q_dense_grid(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return logs.top_item_activity_grid(ev, "event_type", "user_id", "ts", "n")


def q_pivot_grid(spark, sf_dir):
    return grid.pivot_hours(q_dense_grid(spark, sf_dir), ["event_type", "user_id", "day"])


# Fixed values of this catalogue: per-class sampling fractions.
SAMPLE_FRACTIONS = {"F": 0.1, "O": 0.2, "P": 0.3}
SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def q_claim_labels(spark, sf_dir):
    claims = tables.claims_table(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    lab = features.claim_labels(claims)
    return lab.select("policy_id", "nz_claim", "pp_claim_nb",
                      F.round("log_claim_nb", 12).alias("log_claim_nb"))


def _status(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")


def q_stratified_split(spark, sf_dir):
    return sampling.stratified_split(_status(spark, sf_dir), "o_orderstatus", "o_orderkey",
                                     0.7, seed=14)


def q_holdout_split(spark, sf_dir):
    return sampling.holdout_split(_status(spark, sf_dir), "o_orderstatus", "o_orderkey",
                                  0.7, 0.9, seed=14, inner_seed=15)


def q_stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(_status(spark, sf_dir), "o_orderstatus", "o_orderkey",
                                      SAMPLE_FRACTIONS, seed=7)


def q_temporal_split(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (sampling.temporal_split(orders, "o_orderdate", "o_orderkey", (0.4, 0.6, 0.8))
            .select("train_frac", "o_orderkey", "split"))


def q_category_index(spark, sf_dir):
    return features.indexed(_t(spark, sf_dir, "orders"), "o_orderpriority")


def q_category_ranks(spark, sf_dir):
    """The same numbering for any number of categories: users by their number of events."""
    return features.category_index(_t(spark, sf_dir, "events"), "user_id")


def q_one_hot(spark, sf_dir):
    return features.one_hot_sparse(_t(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


def q_scale_features(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SCALED)
    out = features.model_scaled(li, SCALED)
    return out.select("l_orderkey", "l_linenumber",
                      *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in SCALED])


def q_standardise_vectors(spark, sf_dir):
    emb = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    z, _ = features.standardise_array(emb, "embedding", "z")
    return z.select("vec_id", F.posexplode("z").alias("dim", "z")).select(
        "vec_id", F.col("dim").cast("int"), F.round("z", 6).alias("z"))


def q_matrix_transpose(spark, sf_dir):
    long = tables.count_matrix_long(_t(spark, sf_dir, "embeddings"))
    long = long.select(F.col("row_label").alias("vec_id"), "col_pos", "n")
    return grid.transpose_long(long, "vec_id", "col_pos", "n").select(
        F.col("vec_id").alias("row_label"), F.col("col_pos").alias("column_label"), "n")


# Fixed values of this catalogue: the scores being evaluated.
SCORE_INTERCEPT, SCORE_SLOPE = 10.0, 0.1      # prediction of events.value from user_id
LONG_DOC_CHARS = 2000                          # "good quality" when a doc is this long


def q_regression_metrics(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    pred = F.lit(SCORE_INTERCEPT) + F.lit(SCORE_SLOPE) * F.col("user_id")
    m = metrics.regression_metrics(ev, "value", pred, by=["event_type"])
    return m.select("event_type", "n", "n_unscored", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "mse")])


def _labelled_docs(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.join(_t(spark, sf_dir, "labels"), "doc_id")


def q_accuracy_score(spark, sf_dir):
    d = _labelled_docs(spark, sf_dir)
    pred = (F.col("n_chars") >= LONG_DOC_CHARS).cast("double")
    r = metrics.classification_report(d, "quality", pred)
    return r.select("n", "n_unscored", F.round("accuracy", 12).alias("accuracy"), "tp", "fp", "tn", "fn")


def q_auc_score(spark, sf_dir):
    d = _labelled_docs(spark, sf_dir)
    long = d.unpivot("n_chars", ["quality", "toxic"], "label_name", "label")
    r = metrics.area_under_roc(long, "n_chars", "label", by=["label_name"])
    return r.select("label_name", F.round("auc", 12).alias("auc"), "n_pos", "n_neg", "n_unscored")


def q_auc_hard_label(spark, sf_dir):
    """The area under ROC of the predicted label itself, as a classifier without scores gives it."""
    d = _labelled_docs(spark, sf_dir).withColumn("predicted", (F.col("n_chars") >= LONG_DOC_CHARS).cast("double"))
    r = metrics.area_under_roc(d, "predicted", "quality")
    return r.select(F.round("auc", 12).alias("auc"), "n_pos", "n_neg", "n_unscored")


def _claims(spark, sf_dir):
    return tables.claims_table(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))


def _claim_report(name):
    def q(spark, sf_dir):
        m, c = claims.claim_models(spark, _claims(spark, sf_dir), [name], [0.001])
        return claims.report(m, c)
    q.__name__ = f"q_{name}"
    return q


def q_split_distribution(spark, sf_dir):
    labels = features.claim_labels(_claims(spark, sf_dir))
    return claims.split_distribution(labels)


def q_validation_curve(spark, sf_dir):
    return claims.validation_curve(spark, _claims(spark, sf_dir))


def q_linear_curve(spark, sf_dir):
    """The linear part of the validation curve, all strengths from one pass."""
    curve = claims.validation_curve(spark, _claims(spark, sf_dir), names=list(models.LINEAR))
    return curve.select("model", "reg_param", "split", "metric", F.round("value", 7).alias("value"))


def q_curve_table(spark, sf_dir):
    """The linear curve as the comparison table: a column per part."""
    curve = claims.validation_curve(spark, _claims(spark, sf_dir), names=list(models.LINEAR))
    table = selection.compare_table(curve, ["model", "reg_param"], "split", values=["fit", "validate"])
    return table.select("model", "reg_param", *[F.round(c, 7).alias(c) for c in ("fit", "validate")])


def q_model_optimum(spark, sf_dir):
    """Optimality of every regularised fit; predictions add up to labels (here to the nearest half)."""
    r = claims.model_optimum(spark, _claims(spark, sf_dir))
    return r.select("model", "reg_param", "n", F.round("sum_label", 1).alias("sum_label"),
                    (F.round(2 * F.col("sum_predicted")) / 2).alias("sum_predicted"), "at_optimum")


def q_category_rates(spark, sf_dir):
    """Unpenalised fits on one category against their closed forms."""
    rates = claims.category_rates(_claims(spark, sf_dir), "priority", "total_price")
    return rates.select("model", "priority", round_sig("rate", 5).alias("rate"))


def _linear(alpha):
    def q(spark, sf_dir):
        from quarry.operators.linear import one_feature_paths
        li = _t(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
        out = one_feature_paths(spark, li, "l_quantity", "l_extendedprice", alpha,
                                claims.REG_PARAMS)
        return out.select("reg_param", round_sig("slope", 7).alias("slope"),
                          round_sig("intercept", 7).alias("intercept"))
    return q


def _ratings(spark, sf_dir):
    return tables.ratings_table(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"))


def q_recommender_backtest(spark, sf_dir):
    m, _ = recommender.backtest(spark, _ratings(spark, sf_dir))
    return m


def q_ratings_split(spark, sf_dir):
    return recommender.split_summary(recommender.temporal_parts(_ratings(spark, sf_dir)))


def _setting_b(spark, sf_dir):
    parts = recommender.temporal_parts(_ratings(spark, sf_dir))
    _, fitted = recommender.backtest(spark, None, {"B": recommender.SETTINGS["B"]},
                                     parts=parts)
    return parts, fitted


def _clusters(spark, sf_dir):
    """(fraction, parts, clusters) of setting B's users."""
    parts, fitted = _setting_b(spark, sf_dir)
    for f in recommender.FRACTIONS:
        yield f, parts, recommender.taste_clusters(fitted[("B", f)].userFactors)


def q_taste_clusters(spark, sf_dir):
    return union_all(c.largest.select(F.lit(f).alias("train_frac"), "position", "cluster", "size")
                     for f, _, c in _clusters(spark, sf_dir))


def q_cluster_members(spark, sf_dir):
    """Users of the largest cluster of each fraction."""
    return union_all(recommender.largest_members(c, parts).select(F.lit(f).alias("train_frac"), "cluster", "user_id")
                     for f, parts, c in _clusters(spark, sf_dir))


# A centre may lie this far from the mean of its users (as a share of the centres' mean length)
# when the last round ends.
CENTRE_DRIFT = 0.1


def q_cluster_check(spark, sf_dir):
    """Every training user is in the cluster of the nearest centre, and centres are means of their users."""
    rows = []
    for f, _, c in _clusters(spark, sf_dir):
        users, _, wrong, drift = recommender.cluster_check(c)
        rows.append((f, users, wrong, drift <= CENTRE_DRIFT))
    return spark.createDataFrame(rows, "train_frac double, n_users long, n_not_nearest long, centres_are_means boolean")


def q_cluster_genres(spark, sf_dir):
    parts, fitted = _setting_b(spark, sf_dir)
    _, genres = recommender.cluster_genres(parts, fitted, tables.movies_table(_t(spark, sf_dir, "part")))
    return genres.select("train_frac", "rank", "genre", "n")


def q_recommender_optimum(spark, sf_dir):
    """Every back-test fit solves its users' equations; rows trained on, tested and scored."""
    return recommender.recommender_optimum(_ratings(spark, sf_dir)).drop("worst")


def q_backtest_table(spark, sf_dir):
    """The back-test's scores as the comparison table: a column per training fraction."""
    m, _ = recommender.backtest(spark, _ratings(spark, sf_dir))
    return selection.compare_table(m, ["setting", "metric"], "train_frac", values=recommender.FRACTIONS)


def q_genre_top_k(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"),
                                                "c_mktsegment")
    rated = _ratings(spark, sf_dir).join(cust, "user_id")
    movies = tables.movies_table(_t(spark, sf_dir, "part"))
    return recommender.top_genres(rated, movies, ["c_mktsegment"], 10, delimiter=" ")


def _count_matrix(spark, sf_dir):
    """Words (``vec_id``) x papers (vector position)."""
    long = tables.count_matrix_long(_t(spark, sf_dir, "embeddings"))
    return long.select("row_label", F.col("col_pos").alias("column_label"), "n")


def q_paper_projection(spark, sf_dir):
    """The matrix as it is: one observation per ``vec_id``."""
    coords = papers.paper_projection(_count_matrix(spark, sf_dir), transpose=False).coords
    return coords.select(F.col("row_label").alias("vec_id"), F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


def q_paper_vectors(spark, sf_dir):
    rows = papers.paper_vectors(_count_matrix(spark, sf_dir))
    cells = rows.select(F.col("row_label").alias("paper"), "width", F.explode(F.arrays_zip("idx", "val")).alias("c"))
    return cells.select("paper", "width", F.col("c.idx").alias("word_pos"), F.col("c.val").alias("n"))


def q_paper_coords(spark, sf_dir):
    coords = papers.paper_projection(_count_matrix(spark, sf_dir)).coords
    return coords.select(F.col("row_label").alias("paper"), F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


def q_paper_variance(spark, sf_dir):
    variance = papers.paper_projection(_count_matrix(spark, sf_dir)).variance
    return variance.select("component", F.round("eigenvalue", 6).alias("eigenvalue"),
                           F.round("explained_variance", 9).alias("explained_variance"))


def q_paper_loadings(spark, sf_dir):
    loadings = papers.paper_projection(_count_matrix(spark, sf_dir)).loadings
    return loadings.select(F.col("column_label").alias("word"), "component", F.round("loading", 7).alias("loading"))


def _events(spark, sf_dir):
    return tables.collision_events(_t(spark, sf_dir, "lineitem"))


def _search(kind):
    def q(spark, sf_dir):
        with WorkTables(spark, "search") as work:
            base = classifier.assemble(_events(spark, sf_dir), tables.COLLISION_FEATURES, "event_key")
            cv_model, res, _ = classifier.search(classifier.search_parts(base, "event_key", work), kind)
        best = max(range(len(cv_model.avgMetrics)), key=lambda i: (cv_model.avgMetrics[i], -i))
        return res.withColumn("is_best", F.col("combo") == best).withColumn("model", F.lit(kind))
    return q


def q_split_gains(spark, sf_dir):
    """Gains of all root splits of the features with few values, over all events."""
    gains = split_gains(_events(spark, sf_dir), ["l_discount", "l_tax", "line_no"], "label")
    return gains.withColumn("gain", F.round("gain", 12))


def q_tree_check(spark, sf_dir):
    return classifier.tree_check(_events(spark, sf_dir), tables.COLLISION_FEATURES, "event_key")


def q_search_folds(spark, sf_dir):
    return classifier.fold_sizes(_events(spark, sf_dir), "event_key")


def q_best_params(spark, sf_dir):
    """The forest search's chosen parameters as rows."""
    with WorkTables(spark, "search") as work:
        base = classifier.assemble(_events(spark, sf_dir), tables.COLLISION_FEATURES, "event_key")
        _, _, best = classifier.search(classifier.search_parts(base, "event_key", work), "forest")
    return spark.createDataFrame([("forest", k, float(v)) for k, v in best.items()], "model string, param string, value double")


def q_data_balance(spark, sf_dir):
    return classifier.data_balance(_events(spark, sf_dir), "event_key")


def q_classifier_report(spark, sf_dir):
    report, _ = classifier.classifier_report(spark, _events(spark, sf_dir),
                                             tables.COLLISION_FEATURES, "event_key")
    return report.select("model", "stage", "metric", "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "group_counts": q_group_counts,
    "group_distinct": q_group_distinct,
    "class_distribution": q_class_distribution,
    "top_n_per_group": q_top_n_per_group,
    "top_n_vs_rest": q_top_n_vs_rest,
    "top_items": q_top_items,
    "chart_table": q_chart_table,
    "log_parse": q_log_parse,
    "suffix_class": q_suffix_class,
    "calendar_parts": q_calendar_parts,
    "dense_grid": q_dense_grid,
    "pivot_grid": q_pivot_grid,
    "claim_labels": q_claim_labels,
    "stratified_split": q_stratified_split,
    "holdout_split": q_holdout_split,
    "stratified_sample": q_stratified_sample,
    "temporal_split": q_temporal_split,
    "category_index": q_category_index,
    "category_ranks": q_category_ranks,
    "one_hot": q_one_hot,
    "scale_features": q_scale_features,
    "standardise_vectors": q_standardise_vectors,
    "matrix_transpose": q_matrix_transpose,
    "regression_metrics": q_regression_metrics,
    "accuracy_score": q_accuracy_score,
    "auc_score": q_auc_score,
    "auc_hard_label": q_auc_hard_label,
    "linear_l1": _linear(1.0),
    "linear_l2": _linear(0.0),
    "poisson_fit": _claim_report("glm_poisson"),
    "logistic_l1": _claim_report("logistic_l1"),
    "logistic_l2": _claim_report("logistic_l2"),
    "validation_curve": q_validation_curve,
    "linear_curve": q_linear_curve,
    "curve_table": q_curve_table,
    "model_optimum": q_model_optimum,
    "category_rates": q_category_rates,
    "split_distribution": q_split_distribution,
    "recommender_backtest": q_recommender_backtest,
    "ratings_split": q_ratings_split,
    "taste_clusters": q_taste_clusters,
    "cluster_genres": q_cluster_genres,
    "cluster_members": q_cluster_members,
    "cluster_check": q_cluster_check,
    "recommender_optimum": q_recommender_optimum,
    "backtest_table": q_backtest_table,
    "genre_top_k": q_genre_top_k,
    "paper_projection": q_paper_projection,
    "paper_vectors": q_paper_vectors,
    "paper_coords": q_paper_coords,
    "paper_variance": q_paper_variance,
    "paper_loadings": q_paper_loadings,
    "forest_search": _search("forest"),
    "boost_search": _search("boost"),
    "best_params": q_best_params,
    "search_folds": q_search_folds,
    "split_gains": q_split_gains,
    "tree_check": q_tree_check,
    "classifier_report": q_classifier_report,
    "data_balance": q_data_balance,
}
