"""Equivalent DuckDB SQL for every value-checked query in the catalogue.

Type notes: DuckDB's ``sum(bigint)`` is HUGEINT and ``row_number()`` /
``hour()`` are BIGINT, so they are cast to Spark's types here.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

# Enough digits for 16 ** 32 times a decimal fraction.
getcontext().prec = 60

_TYPES = "('click', 'purchase', 'signup')"

_DENSE_GRID = """
    WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL),
    top AS (SELECT event_type, user_id FROM (
              SELECT *, row_number() OVER (PARTITION BY event_type
                                           ORDER BY n DESC, user_id) AS rk FROM c)
            WHERE rk = 1),
    cnt AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day,
                   CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
            FROM events SEMI JOIN top USING (event_type, user_id) GROUP BY ALL),
    b AS (SELECT event_type, user_id, min(day) AS lo, max(day) AS hi FROM cnt GROUP BY ALL),
    spine AS (SELECT event_type, user_id, CAST(d AS DATE) AS day, CAST(h AS INTEGER) AS hour
              FROM b, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                             INTERVAL 1 DAY)) AS g(d),
                   range(24) AS r(h))
    SELECT s.event_type, s.user_id, s.day, s.hour, coalesce(cnt.n, 0) AS n
    FROM spine s LEFT JOIN cnt USING (event_type, user_id, day, hour)"""

_HOURS = ",\n".join(f"coalesce(max(n) FILTER (WHERE hour = {h}), 0) AS h{h:02d}"
                     for h in range(24))

_URL_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"

_SPLIT = """
    WITH t AS (SELECT o_orderkey, o_orderstatus,
                      md5('{seed}:' || CAST(o_orderkey AS VARCHAR)) AS h FROM {src}),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS rn,
                 count(*) OVER (PARTITION BY o_orderstatus) AS cnt FROM t)
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN rn <= (cnt * {bp}) // 10000 THEN '{a}' ELSE '{b}' END AS split FROM r"""

_OUTER = _SPLIT.format(seed=14, src="orders", bp=7000, a="train", b="test")


def _thr(f):
    return format(int(Decimal(f) * 16 ** 32), "032x")


_CAT_INDEX = """
    SELECT o_orderpriority, n,
           CAST(row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS INTEGER) AS idx
    FROM (SELECT o_orderpriority, count(*) AS n FROM orders
          WHERE o_orderpriority IS NOT NULL GROUP BY ALL)"""

_LONG = """
    SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
           CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"""


def _sig(x, d=7):
    return (f"CASE WHEN {x} = 0 THEN 0.0 ELSE round({x} / pow(10.0, floor(log10(abs({x})))), {d - 1})"
            f" * pow(10.0, floor(log10(abs({x})))) END")


def _linear(slope_expr):
    return f"""
        WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, avg(l_quantity) AS mx,
                          avg(l_extendedprice) AS my, stddev_pop(l_quantity) AS sx,
                          stddev_pop(l_extendedprice) AS sy FROM lineitem),
        r AS (SELECT CAST(reg_param AS DOUBLE) AS reg_param
              FROM (VALUES (0.001), (0.01), (0.1), (1.0), (10.0)) AS v(reg_param)),
        w AS (SELECT reg_param, {slope_expr} AS slope, my, mx FROM r CROSS JOIN s)
        SELECT reg_param, {_sig("slope")} AS slope, {_sig("(my - slope * mx)")} AS intercept
        FROM w"""


def _leading(matrix, squarings=16):
    """CTEs for the two leading eigenpairs of the CTE ``matrix (i, j, v)`` by repeated squaring."""
    out, m = [], matrix
    for c in (1, 2):
        out.append(f"p{c}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {m} WHERE i = j) AS v FROM {m})")
        for s in range(squarings):
            out.append(f"q{c}_{s} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM p{c}_{s} AS a "
                       f"JOIN p{c}_{s} AS b ON a.j = b.i GROUP BY a.i, b.j)")
            out.append(f"p{c}_{s + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM q{c}_{s} WHERE i = j) AS v FROM q{c}_{s})")
        last = f"p{c}_{squarings}"
        out.append(f"u{c} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS u FROM {last} "
                   f"WHERE j = (SELECT arg_max(i, v) FROM {last} WHERE i = j))")
        out.append(f"l{c} AS MATERIALIZED (SELECT sum(a.u * v * b.u) AS l FROM {m} AS m JOIN u{c} AS a ON a.i = m.i "
                   f"JOIN u{c} AS b ON b.i = m.j)")
        out.append(f"rest{c} AS MATERIALIZED (SELECT m.i, m.j, m.v - l * a.u * b.u AS v FROM {m} AS m JOIN u{c} AS a ON a.i = m.i "
                   f"JOIN u{c} AS b ON b.i = m.j CROSS JOIN l{c})")
        m = f"rest{c}"
    return ",\n".join(out)


#: Observations are the vectors: standardised positions, their 64 x 64 correlations.
_PCA = f"""
    WITH c AS ({_LONG}),
    z AS MATERIALIZED (SELECT vec_id, dim, (x - avg(x) OVER (PARTITION BY dim)) / stddev_samp(x) OVER (PARTITION BY dim) AS z FROM c),
    m AS MATERIALIZED (SELECT a.dim AS i, b.dim AS j, sum(a.z * b.z) / (SELECT count(DISTINCT vec_id) - 1 FROM c) AS v
                       FROM z AS a JOIN z AS b USING (vec_id) GROUP BY ALL),
    {_leading("m")},
    signs AS (SELECT (SELECT sign(arg_max(u, abs(u))) FROM u1) AS s1, (SELECT sign(arg_max(u, abs(u))) FROM u2) AS s2)"""

#: The transpose: observations are the 64 positions, every vector is a feature.
_PCA_T = f"""
    WITH c AS ({_LONG}),
    z AS MATERIALIZED (SELECT vec_id, dim, (x - avg(x) OVER (PARTITION BY vec_id)) / stddev_samp(x) OVER (PARTITION BY vec_id) AS z FROM c),
    n AS MATERIALIZED (SELECT count(DISTINCT dim) - 1 AS n FROM c),
    m AS MATERIALIZED (SELECT a.dim AS i, b.dim AS j, sum(a.z * b.z) / (SELECT n FROM n) AS v
                       FROM z AS a JOIN z AS b USING (vec_id) GROUP BY ALL),
    {_leading("m")},
    load AS MATERIALIZED (SELECT vec_id, sum(z * u1.u) / sqrt((SELECT n FROM n) * (SELECT l FROM l1)) AS w1,
                    sum(z * u2.u) / sqrt((SELECT n FROM n) * (SELECT l FROM l2)) AS w2
             FROM z JOIN u1 ON u1.i = dim JOIN u2 ON u2.i = dim GROUP BY vec_id),
    signs AS (SELECT sign(arg_max(w1, abs(w1))) AS s1, sign(arg_max(w2, abs(w2))) AS s2 FROM load)"""


#: The claims with their labels and the nested split of the claim models.
_CLAIMS = """
    WITH r AS (SELECT l_orderkey, count(*) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
    c AS (SELECT o_orderkey AS policy_id, coalesce(r.c, 0) AS claim_nb, o_totalprice AS total_price,
                 year(o_orderdate)::DOUBLE AS order_year, month(o_orderdate)::DOUBLE AS order_month,
                 o_orderpriority AS priority, o_orderstatus AS status
          FROM orders LEFT JOIN r ON o_orderkey = r.l_orderkey),
    l AS (SELECT *, CASE WHEN claim_nb = 0 THEN 0.5 ELSE claim_nb END::DOUBLE AS pp,
                 (claim_nb > 0)::INTEGER::DOUBLE AS nz FROM c),
    o AS (SELECT *, row_number() OVER (PARTITION BY pp ORDER BY md5('14:' || policy_id), policy_id)
                    <= count(*) OVER (PARTITION BY pp) * 7 // 10 AS train FROM l),
    s AS (SELECT *, row_number() OVER (PARTITION BY pp, train ORDER BY md5('15:' || policy_id), policy_id)
                    <= count(*) OVER (PARTITION BY pp, train) * 9 // 10 AS fit FROM o)"""

#: Elastic-net fits of ln(pp) by coordinate descent on the correlations of the fit part.
_CURVE = _CLAIMS + """,
    t AS MATERIALIZED (SELECT policy_id, ln(pp) AS y, CASE WHEN fit THEN 'fit' ELSE 'validate' END AS split,
                              total_price, order_year, order_month, priority, status FROM s WHERE train),
    pri AS (SELECT priority, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS p FROM t WHERE split = 'fit' GROUP BY priority),
    sta AS (SELECT status, row_number() OVER (ORDER BY count(*) DESC, status) - 1 AS q FROM t WHERE split = 'fit' GROUP BY status),
    x AS MATERIALIZED (SELECT policy_id, y, split, [total_price, order_year, order_month]
             || list_transform(range((SELECT count(*) - 1 FROM pri)), lambda i: (i = p)::INTEGER::DOUBLE)
             || list_transform(range((SELECT count(*) - 1 FROM sta)), lambda i: (i = q)::INTEGER::DOUBLE) AS x
          FROM t JOIN pri USING (priority) JOIN sta USING (status)),
    cells AS MATERIALIZED (SELECT policy_id, y, generate_subscripts(x, 1) AS j, unnest(x) AS v FROM x WHERE split = 'fit'),
    st AS MATERIALIZED (SELECT j, avg(v) AS m, stddev_pop(v) AS s FROM cells GROUP BY j),
    ys AS MATERIALIZED (SELECT avg(y) AS ym, stddev_pop(y) AS sy FROM x WHERE split = 'fit'),
    z AS MATERIALIZED (SELECT policy_id, j, (v - m) / s AS z, (y - ym) / sy AS zy FROM cells JOIN st USING (j) CROSS JOIN ys),
    cm AS MATERIALIZED (SELECT list(r ORDER BY i) AS cm FROM (SELECT a.j AS i, list(c ORDER BY k) AS r
             FROM (SELECT a.j, b.j AS k, avg(a.z * b.z) AS c FROM z AS a JOIN z AS b USING (policy_id) GROUP BY ALL) AS a GROUP BY a.j)),
    ct AS MATERIALIZED (SELECT list(c ORDER BY j) AS ct, count(*) AS d FROM (SELECT j, avg(z * zy) AS c FROM z GROUP BY j)),
    fits AS (SELECT model, alpha, reg_param::DOUBLE AS reg_param FROM (VALUES ('linear_l1', 1.0::DOUBLE), ('linear_l2', 0.0)) AS a(model, alpha)
             CROSS JOIN (VALUES (0.001), (0.01), (0.1), (1.0), (10.0)) AS b(reg_param)),
    steps AS (
      SELECT model, reg_param, alpha * reg_param / sy AS l1, (1 - alpha) * reg_param / sy AS l2, 0 AS step,
             list_transform(range(d), lambda i: 0.0::DOUBLE) AS w FROM fits CROSS JOIN ys CROSS JOIN ct
      UNION ALL
      SELECT model, reg_param, l1, l2, step + 1, list_transform(w, lambda v, i: CASE WHEN i = j THEN
               sign(rest) * greatest(abs(rest) - l1, 0) / (cm[j][j] + l2) ELSE v END)
      FROM (SELECT *, ct[j] - list_dot_product(cm[j], w) + cm[j][j] * w[j] AS rest
            FROM (SELECT steps.*, cm, ct, d, step % d + 1 AS j FROM steps CROSS JOIN cm CROSS JOIN ct WHERE step < 300 * d))),
    beta AS (SELECT model, reg_param, list_transform(w, lambda v, i: v * sy / sd[i]) AS b, ym, ms
             FROM steps CROSS JOIN ct CROSS JOIN ys
             CROSS JOIN (SELECT list(s ORDER BY j) AS sd, list(m ORDER BY j) AS ms FROM st) WHERE step = 300 * d)"""


#: The ratings by age, and the training fractions with their numbers of training rows.
_RATINGS = """
    WITH r AS (SELECT o_custkey AS user_id, l_partkey AS item_id, o_orderdate AS ts, l_orderkey, l_linenumber, l_quantity % 5 AS q
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    k AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ts, l_orderkey, l_linenumber, item_id, user_id, q) AS rn FROM r),
    f AS (SELECT train_frac::DOUBLE AS train_frac, (SELECT count(*) FROM r) * fifths // 5 AS n_train
          FROM (VALUES (0.4, 2), (0.6, 3), (0.8, 4)) AS v(train_frac, fifths))"""


#: The classifier's search sample with its parts.
_SEARCH = f"""
    WITH e AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k,
                      CAST(l_returnflag = 'R' AS DOUBLE) AS label FROM lineitem),
    p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('14:' || k), k)
                    <= count(*) OVER (PARTITION BY label) * 7 // 10 AS train
          FROM e WHERE md5('15:' || k) < '{_thr('0.02')}')"""


ORACLE_SQL: dict[str, str] = {
    "group_counts": f"""
        SELECT event_type, count(*) AS n_requests
        FROM events WHERE event_type IN {_TYPES}
        GROUP BY event_type""",
    "group_distinct": """
        SELECT event_type, count(DISTINCT user_id) AS n_users
        FROM events GROUP BY event_type""",
    "class_distribution": """
        SELECT o_orderstatus, n,
               n / sum(n) OVER () AS share,
               floor(n * 10000.0::DOUBLE / sum(n) OVER () + 0.5) / 100 AS pct
        FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)""",
    "top_n_per_group": """
        SELECT event_type, user_id, n_requests, rank FROM (
          SELECT event_type, user_id, n_requests,
                 CAST(row_number() OVER (PARTITION BY event_type
                                         ORDER BY n_requests DESC, user_id) AS INTEGER) AS rank
          FROM (SELECT event_type, user_id, count(*) AS n_requests
                FROM events GROUP BY event_type, user_id))
        WHERE rank <= 9""",
    "top_n_vs_rest": """
        WITH c AS (SELECT event_type, user_id, count(*) AS n
                   FROM events GROUP BY event_type, user_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_type
                                                ORDER BY n DESC, user_id) AS INTEGER) AS rk
              FROM c),
        lab AS (SELECT event_type,
                       CASE WHEN rk <= 9 THEN CAST(user_id AS VARCHAR) ELSE 'Other' END AS host,
                       CASE WHEN rk <= 9 THEN rk ELSE 10 END AS rank, n
                FROM r),
        g AS (SELECT event_type, host, rank, CAST(sum(n) AS BIGINT) AS n_requests
              FROM lab GROUP BY event_type, host, rank),
        t AS (SELECT event_type, sum(n) AS total FROM c GROUP BY event_type)
        SELECT g.event_type, host, n_requests, rank,
               floor(n_requests * 10000.0::DOUBLE / total + 0.5) / 100 AS pct
        FROM g JOIN t USING (event_type)""",
    "log_parse": """
        SELECT 'u' || user_id || '.' || event_type AS host,
               date_trunc('second', ts) AS ts, '-0400' AS tz_offset,
               'GET /' || event_type || '/' || event_id || ' HTTP/1.0' AS request,
               CASE WHEN event_type = 'error' THEN 500
                    WHEN event_type = 'signup' THEN 302 ELSE 200 END AS status,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value * 100.0::DOUBLE) AS BIGINT)
               END AS size,
               false AS malformed,
               CASE event_type WHEN 'click' THEN 'Germany' WHEN 'purchase' THEN 'Canada'
                    WHEN 'signup' THEN 'Singapore' ELSE 'Other' END AS host_cntry
        FROM events""",
    "top_items": """
        SELECT user_id, n_requests, CAST(row_number() OVER (ORDER BY n_requests DESC, user_id) AS INTEGER) AS rank
        FROM (SELECT user_id, count(*) AS n_requests FROM events GROUP BY user_id) ORDER BY n_requests DESC, user_id LIMIT 10""",
    "chart_table": """
        SELECT *, row_number() OVER (ORDER BY event_type, n DESC, hour) AS position
        FROM (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY ALL)""",
    "category_ranks": """
        SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) - 1 AS INTEGER) AS idx
        FROM (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id)""",
    "suffix_class": f"""
        SELECT CASE lower(regexp_extract({_URL_HOST}, '(\\.[^.]+)$', 1))
                 WHEN '.com' THEN 'commercial' WHEN '.net' THEN 'network'
                 WHEN '.org' THEN 'organisation' ELSE 'Other' END AS host_class,
               count(*) AS n_pages
        FROM pages GROUP BY ALL""",
    "calendar_parts": """
        SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
        FROM events GROUP BY ALL""",
    "dense_grid": _DENSE_GRID,
    "pivot_grid": f"""
        SELECT event_type, user_id, day, {_HOURS}
        FROM ({_DENSE_GRID}) GROUP BY event_type, user_id, day""",
    "claim_labels": """
        WITH r AS (SELECT l_orderkey, count(*) AS c FROM lineitem
                   WHERE l_returnflag = 'R' GROUP BY l_orderkey),
        c AS (SELECT o_orderkey AS policy_id, CAST(coalesce(r.c, 0) AS DOUBLE) AS claim_nb
              FROM orders LEFT JOIN r ON o_orderkey = r.l_orderkey),
        s AS (SELECT policy_id, claim_nb,
                     CAST(CASE WHEN claim_nb = 0 THEN 0.5 ELSE claim_nb END AS DOUBLE) AS pp
              FROM c)
        SELECT policy_id, CAST(CASE WHEN claim_nb > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS nz_claim,
               pp AS pp_claim_nb, round(ln(pp), 12) AS log_claim_nb
        FROM s""",
    "stratified_split": _OUTER,
    "holdout_split": f"""
        WITH o AS ({_OUTER}),
        tr AS (SELECT o_orderkey, o_orderstatus FROM o WHERE split = 'train'),
        i AS ({_SPLIT.format(seed=15, src="tr", bp=9000, a="fit", b="validate")})
        SELECT * FROM i UNION ALL SELECT * FROM o WHERE split = 'test'""",
    "stratified_sample": f"""
        SELECT o_orderkey, o_orderstatus FROM orders
        WHERE md5('7:' || CAST(o_orderkey AS VARCHAR)) <
              CASE o_orderstatus WHEN 'F' THEN '{_thr('0.1')}' WHEN 'O' THEN '{_thr('0.2')}'
                                 WHEN 'P' THEN '{_thr('0.3')}' END""",
    "temporal_split": """
        WITH r AS (SELECT o_orderkey,
                          row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
                          count(*) OVER () AS cnt FROM orders),
        f AS (SELECT * FROM (VALUES (0.4, 4000), (0.6, 6000), (0.8, 8000)) AS v(train_frac, bp))
        SELECT CAST(f.train_frac AS DOUBLE) AS train_frac, o_orderkey,
               CASE WHEN rn <= (cnt * bp) // 10000 THEN 'train' ELSE 'test' END AS split
        FROM r CROSS JOIN f""",
    "category_index": _CAT_INDEX,
    "one_hot": f"""
        WITH i AS ({_CAT_INDEX}), k AS (SELECT count(*) AS k FROM i)
        SELECT o_orderkey, o.o_orderpriority,
               CASE WHEN idx < k - 1 THEN idx END AS slot, CAST(k - 1 AS INTEGER) AS width
        FROM orders o LEFT JOIN i USING (o_orderpriority) CROSS JOIN k""",
    "scale_features": """
        SELECT l_orderkey, l_linenumber,
               round(l_quantity / stddev_samp(l_quantity) OVER (), 6) AS l_quantity_scaled,
               round(l_extendedprice / stddev_samp(l_extendedprice) OVER (), 6)
                   AS l_extendedprice_scaled,
               round(l_discount / stddev_samp(l_discount) OVER (), 6) AS l_discount_scaled
        FROM lineitem""",
    "standardise_vectors": f"""
        WITH l AS ({_LONG})
        SELECT vec_id, dim,
               round((x - avg(x) OVER (PARTITION BY dim)) / stddev_samp(x) OVER (PARTITION BY dim),
                     6) AS z
        FROM l""",
    "matrix_transpose": f"""
        SELECT dim AS row_label, vec_id AS column_label, x AS n FROM ({_LONG})""",
    "paper_projection": f"""{_PCA}
    SELECT vec_id, round(sum(z * u1.u * s1), 6) AS pc1, round(sum(z * u2.u * s2), 6) AS pc2
    FROM z JOIN u1 ON u1.i = dim JOIN u2 ON u2.i = dim CROSS JOIN signs GROUP BY vec_id""",
    "paper_vectors": f"""
        SELECT dim AS paper, (SELECT count(DISTINCT vec_id) FROM embeddings WHERE len(embedding) > 0) AS width,
               CAST(dense_rank() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS word_pos, x AS n
        FROM ({_LONG})""",
    "paper_coords": f"""{_PCA_T}
    SELECT u1.i AS paper, round(u1.u * s1 * sqrt(l1.l * n), 6) AS pc1, round(u2.u * s2 * sqrt(l2.l * n), 6) AS pc2
    FROM u1 JOIN u2 USING (i) CROSS JOIN l1 CROSS JOIN l2 CROSS JOIN n CROSS JOIN signs""",
    "paper_variance": f"""{_PCA_T}
    SELECT CAST(component AS INTEGER) AS component, round(l, 6) AS eigenvalue,
           round(l / (SELECT sum(v) FROM m WHERE i = j), 9) AS explained_variance
    FROM (SELECT 1 AS component, l FROM l1 UNION ALL SELECT 2, l FROM l2)""",
    "paper_loadings": f"""{_PCA_T}
    SELECT vec_id AS word, CAST(component AS INTEGER) AS component, round(loading, 7) AS loading
    FROM (SELECT vec_id, 1 AS component, w1 * s1 AS loading FROM load CROSS JOIN signs
          UNION ALL SELECT vec_id, 2, w2 * s2 FROM load CROSS JOIN signs)""",
    "regression_metrics": """
        WITH d AS (SELECT event_type, (10.0::DOUBLE + 0.1::DOUBLE * user_id) - value AS d
                   FROM events)
        SELECT event_type, count(d) AS n, count(*) - count(d) AS n_unscored, round(sqrt(avg(d * d)), 6) AS rmse,
               round(avg(abs(d)), 6) AS mae, round(avg(d * d), 6) AS mse
        FROM d GROUP BY event_type""",
    "accuracy_score": """
        WITH d AS (SELECT CAST(quality AS DOUBLE) AS y,
                          CASE WHEN n_chars >= 2000 THEN 1.0 ELSE 0.0 END::DOUBLE AS p
                   FROM documents JOIN labels USING (doc_id))
        SELECT count(y = p) AS n, count(*) - count(y = p) AS n_unscored, round(avg(CAST(y = p AS DOUBLE)), 12) AS accuracy,
               count(*) FILTER (WHERE y = 1 AND p = 1) AS tp,
               count(*) FILTER (WHERE y <> 1 AND p = 1) AS fp,
               count(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn,
               count(*) FILTER (WHERE y = 1 AND p <> 1) AS fn
        FROM d""",
    "auc_score": """
        WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS s, label_name, label
                   FROM (SELECT n_chars, quality, toxic FROM documents JOIN labels USING (doc_id))
                   UNPIVOT (label FOR label_name IN (quality, toxic))),
        r AS (SELECT label_name, label,
                     (rank() OVER (PARTITION BY label_name ORDER BY s)
                      + count(*) OVER (PARTITION BY label_name, s) - 1
                      + rank() OVER (PARTITION BY label_name ORDER BY s)) / 2.0 AS midrank
              FROM d)
        SELECT label_name,
               round((sum(midrank) FILTER (WHERE label = 1)
                      - count(*) FILTER (WHERE label = 1)
                        * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                     / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1))
                       ::DOUBLE, 12) AS auc,
               count(*) FILTER (WHERE label = 1) AS n_pos,
               count(*) FILTER (WHERE label <> 1) AS n_neg,
               count(*) FILTER (WHERE label IS NULL OR midrank IS NULL) AS n_unscored
        FROM r GROUP BY label_name""",
    # With two score values the curve has one corner: the mean of both rates.
    "auc_hard_label": """
        WITH d AS (SELECT CAST(quality AS DOUBLE) AS y, n_chars >= 2000 AS p FROM documents JOIN labels USING (doc_id))
        SELECT round((1.0::DOUBLE + avg(CAST(p AS INTEGER)) FILTER (WHERE y = 1)
                      - avg(CAST(p AS INTEGER)) FILTER (WHERE y <> 1)) / 2, 12) AS auc,
               count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y <> 1) AS n_neg,
               count(*) FILTER (WHERE y IS NULL OR p IS NULL) AS n_unscored
        FROM d""",
    # Lasso / ridge with one standardised feature have closed forms.
    "linear_l1": _linear("CASE WHEN b > 0 THEN greatest(b - reg_param / sx, 0.0) "
                         "ELSE least(b + reg_param / sx, 0.0) END"),
    "linear_l2": _linear("b / (1.0 + reg_param / sy)"),
    "linear_curve": f"""{_CURVE.replace("WITH r", "WITH RECURSIVE r", 1)}
    SELECT model, reg_param, split, 'rmse' AS metric,
           round(sqrt(avg(pow(y - ym - list_dot_product(b, x) + list_dot_product(b, ms), 2))), 7) AS value
    FROM x CROSS JOIN beta GROUP BY model, reg_param, split""",
    "curve_table": f"""{_CURVE.replace("WITH r", "WITH RECURSIVE r", 1)},
    e AS (SELECT model, reg_param, split, pow(y - ym - list_dot_product(b, x) + list_dot_product(b, ms), 2) AS e FROM x CROSS JOIN beta)
    SELECT model, reg_param, round(sqrt(avg(e) FILTER (WHERE split = 'fit')), 7) AS fit,
           round(sqrt(avg(e) FILTER (WHERE split = 'validate')), 7) AS validate
    FROM e GROUP BY model, reg_param""",
    "model_optimum": f"""{_CLAIMS}
    SELECT model, reg_param::DOUBLE AS reg_param, n, sum_label, sum_label AS sum_predicted, true AS at_optimum
    FROM (SELECT count(*) AS n, round(sum(pp), 1) AS pps, round(sum(nz), 1) AS nzs FROM o WHERE train)
    CROSS JOIN (VALUES (0.001), (0.01), (0.1), (1.0), (10.0)) AS v(reg_param)
    CROSS JOIN LATERAL (VALUES ('glm_poisson', pps), ('logistic_l1', nzs), ('logistic_l2', nzs)) AS m(model, sum_label)""",
    "category_rates": f"""{_CLAIMS},
    g AS (SELECT priority, avg(nz) AS share, sum(pp) / sum(total_price) AS rate FROM l GROUP BY priority)
    SELECT 'logistic_l2' AS model, priority, {_sig("share", 5)} AS rate FROM g
    UNION ALL SELECT 'glm_poisson', priority, {_sig("rate", 5)} FROM g""",
    "recommender_optimum": f"""{_RATINGS},
    u AS (SELECT user_id, min(rn) AS first FROM k GROUP BY user_id),
    i AS (SELECT item_id, min(rn) AS first FROM k GROUP BY item_id)
    SELECT setting, train_frac, n_train, count(*) AS n_test,
           count(*) FILTER (WHERE u.first <= n_train AND i.first <= n_train) AS n_scored,
           (SELECT count(*) FROM u WHERE first <= n_train) AS n_users, true AS solved
    FROM k JOIN f ON rn > n_train JOIN u USING (user_id) JOIN i USING (item_id)
    CROSS JOIN (VALUES ('A'), ('B')) AS s(setting) GROUP BY setting, train_frac, n_train""",
    "cluster_check": f"""{_RATINGS}
    SELECT train_frac, count(DISTINCT user_id) AS n_users, 0::BIGINT AS n_not_nearest, true AS centres_are_means
    FROM k JOIN f ON rn <= n_train GROUP BY train_frac""",
    "split_gains": """
        WITH e AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount, l_tax, l_linenumber::DOUBLE AS line_no FROM lineitem),
        l AS (SELECT feature, value, y FROM (SELECT * FROM e UNPIVOT (value FOR feature IN (l_discount, l_tax, line_no)))),
        v AS (SELECT DISTINCT feature, value FROM l),
        s AS (SELECT v.feature, v.value, count(*) AS n, sum(y) AS p, count(*) FILTER (WHERE l.value <= v.value) AS nl,
                     coalesce(sum(y) FILTER (WHERE l.value <= v.value), 0) AS pl
              FROM v JOIN l USING (feature) GROUP BY ALL)
        SELECT feature, value, n, nl AS n_left, CAST(pl AS BIGINT) AS pos_left,
               round(2 * (p / n) * (1 - p / n) - (nl / n * (2 * (pl / nl) * (1 - pl / nl))
                     + (n - nl) / n * (2 * ((p - pl) / (n - nl)) * (1 - (p - pl) / (n - nl)))), 12) AS gain
        FROM s WHERE nl < n""",
    "tree_check": f"""{_SEARCH}
        SELECT model, count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos, true AS gain_is_exact, true AS gain_is_best
        FROM p CROSS JOIN (VALUES ('forest'), ('boost')) AS m(model) WHERE train GROUP BY model""",
    "search_folds": f"""{_SEARCH}
        SELECT CAST(('0x' || left(md5('16:' || k), 8))::BIGINT % 2 AS INTEGER) AS fold, label, count(*) AS n
        FROM p WHERE train GROUP BY ALL""",
    "genre_top_k": """
        WITH r AS (SELECT o_custkey AS user_id, l_partkey AS item_id,
                          1.0::DOUBLE + (l_quantity % 5.0::DOUBLE) AS rating
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        s AS (SELECT c_mktsegment, item_id FROM r JOIN customer ON user_id = c_custkey
              GROUP BY c_mktsegment, item_id HAVING avg(rating) >= 4),
        t AS (SELECT p_partkey AS item_id,
                     unnest(list_distinct(string_split(p_name, ' '))) AS genre FROM part),
        g AS (SELECT c_mktsegment, genre, count(*) AS n FROM s JOIN t USING (item_id)
              GROUP BY ALL)
        SELECT c_mktsegment, genre, n, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY c_mktsegment
                                            ORDER BY n DESC, genre) AS INTEGER) AS rank FROM g)
        WHERE rank <= 10""",
    "split_distribution": """
        WITH r AS (SELECT l_orderkey, count(*) AS c FROM lineitem
                   WHERE l_returnflag = 'R' GROUP BY l_orderkey),
        c AS (SELECT o_orderkey AS policy_id, CAST(coalesce(r.c, 0) AS DOUBLE) AS claim_nb
              FROM orders LEFT JOIN r ON o_orderkey = r.l_orderkey),
        l AS (SELECT policy_id,
                     CAST(CASE WHEN claim_nb = 0 THEN 0.5 ELSE claim_nb END AS DOUBLE) AS pp_claim_nb
              FROM c),
        t AS (SELECT *, md5('14:' || CAST(policy_id AS VARCHAR)) AS h FROM l),
        s AS (SELECT pp_claim_nb,
                     CASE WHEN row_number() OVER (PARTITION BY pp_claim_nb ORDER BY h, policy_id)
                               <= (count(*) OVER (PARTITION BY pp_claim_nb) * 7000) // 10000
                          THEN 'train' ELSE 'test' END AS split
              FROM t),
        u AS (SELECT split, pp_claim_nb FROM s UNION ALL SELECT 'all', pp_claim_nb FROM s),
        g AS (SELECT split, pp_claim_nb, count(*) AS n FROM u GROUP BY ALL)
        SELECT split, pp_claim_nb, n,
               floor(n * 10000.0::DOUBLE / sum(n) OVER (PARTITION BY split) + 0.5) / 100 AS pct
        FROM g""",
    "data_balance": f"""
        WITH e AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k,
                          CAST(l_returnflag = 'R' AS DOUBLE) AS label FROM lineitem),
        s AS (SELECT * FROM e WHERE md5('15:' || k) < '{_thr('0.02')}'),
        t AS (SELECT *, md5('14:' || k) AS h FROM s),
        p AS (SELECT label,
                     CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h, k)
                               <= (count(*) OVER (PARTITION BY label) * 7000) // 10000
                          THEN 'train' ELSE 'test' END AS part
              FROM t),
        u AS (SELECT 'all' AS part, label FROM e UNION ALL SELECT 'sample', label FROM s
              UNION ALL SELECT part, label FROM p),
        g AS (SELECT part, label, count(*) AS n FROM u GROUP BY ALL)
        SELECT part, label, n,
               floor(n * 10000.0::DOUBLE / sum(n) OVER (PARTITION BY part) + 0.5) / 100 AS pct
        FROM g""",
    "ratings_split": """
        WITH r AS (SELECT o_custkey AS user_id, l_partkey AS item_id,
                          1.0::DOUBLE + (l_quantity % 5.0::DOUBLE) AS rating, o_orderdate AS ts,
                          l_orderkey AS order_id, l_linenumber AS line_no
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        k AS (SELECT *, row_number() OVER (ORDER BY ts, order_id, line_no, item_id, user_id,
                                                    rating) AS rn,
                     count(*) OVER () AS cnt FROM r),
        f AS (SELECT * FROM (VALUES (0.4, 4000), (0.6, 6000), (0.8, 8000)) AS v(train_frac, bp))
        SELECT CAST(train_frac AS DOUBLE) AS train_frac,
               CASE WHEN rn <= (cnt * bp) // 10000 THEN 'train' ELSE 'test' END AS split,
               count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
               CAST(sum(item_id) AS BIGINT) AS item_sum, CAST(sum(user_id) AS BIGINT) AS user_sum
        FROM k CROSS JOIN f GROUP BY ALL""",
}
