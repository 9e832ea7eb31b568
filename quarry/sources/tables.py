"""Stand-ins: the reference's logical inputs derived from the driver tables.

The reference reads an access log, a claims CSV, ratings + movies CSVs, a
word x paper count matrix and a collision-event CSV.  The test data are
TPC-H-like tables instead, so each input is *derived by Spark* from them;
all work still grows with the tables.

=================  ==========================================================
access log         ``events``: one line per event (host ``u<user>.<type>``)
claims             ``orders`` with claim count = returned lines of the order
ratings            ``lineitem`` x ``orders``: customer rates part
movies             ``part``: title = ``p_name``, genres = its words
count matrix       ``embeddings``: one row per vector, one column per dim
collision events   ``lineitem``: label = returned line, numeric features
=================  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.logs import render_log_line

LOG_OFFSET = "-0400"


def log_status(event_type) -> F.Column:
    return (F.when(event_type == "error", F.lit(500))
            .when(event_type == "signup", F.lit(302)).otherwise(F.lit(200)))


def log_size(event_type, value) -> F.Column:
    return F.when(event_type != "error", F.floor(value * F.lit(100.0)).cast("long"))


def access_log_lines(events: DataFrame) -> DataFrame:
    """Render every event as one access-log text line (column ``value``)."""
    et = F.col("event_type")
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    return events.select(*cols).select(render_log_line(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("."), et),
        F.col("ts"), LOG_OFFSET,
        F.concat(F.lit("GET /"), et, F.lit("/"), F.col("event_id").cast("string"),
                 F.lit(" HTTP/1.0")),
        log_status(et), log_size(et, F.col("value"))).alias("value"))


def claims_table(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order: claim count (returned lines, 0 when none) + features.

    The returned lines are counted before the join (partial aggregation on
    the map side), so only one row per order crosses the shuffle.
    """
    returned = (lineitem.filter(F.col("l_returnflag") == "R")
                .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_r")))
    return (orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("policy_id"),
                    F.coalesce(F.col("_r"), F.lit(0)).cast("double").alias("claim_nb"),
                    F.col("o_totalprice").alias("total_price"),
                    F.year("o_orderdate").cast("double").alias("order_year"),
                    F.month("o_orderdate").cast("double").alias("order_month"),
                    F.col("o_orderpriority").alias("priority"),
                    F.col("o_orderstatus").alias("status")))


def ratings_table(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Explicit ratings: customer (user) rates part (item) at the order date.

    ``rating = 1 + l_quantity mod 5`` (1..5).  Ids keep their key type; the
    recommender maps them to dense int ids for ALS.
    """
    return (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    (F.lit(1.0) + F.pmod(F.col("l_quantity"), F.lit(5.0))).alias("rating"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_no")))


def movies_table(part: DataFrame) -> DataFrame:
    """Items with a title and a delimiter-separated genre list (``p_name`` words)."""
    return part.select(F.col("p_partkey").alias("item_id"),
                       F.col("p_name").alias("title"),
                       F.col("p_name").alias("genres"))


def count_matrix_long(embeddings: DataFrame) -> DataFrame:
    """Long form ``(row_label, column_label, col_pos, n)`` of the vector matrix."""
    return embeddings.select(
        F.col("vec_id").alias("row_label"),
        F.posexplode("embedding").alias("col_pos", "n")
    ).select("row_label", F.col("col_pos").cast("int"), F.col("n").cast("double"))


COLLISION_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                      "line_no", "ship_doy"]


def collision_events(lineitem: DataFrame) -> DataFrame:
    """Binary label (returned line) + numeric features, as the classifier input.

    ``event_key`` identifies a line for hashing (sampling, splits, folds).
    """
    return lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_key"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"),
        F.col("l_linenumber").cast("double").alias("line_no"),
        F.dayofyear("l_shipdate").cast("double").alias("ship_doy"))
