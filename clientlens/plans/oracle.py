"""Independent SQL twins of the fixture plans, written for DuckDB over the
pre-registered fixture views. Same column names and types as the Spark side;
rates are DOUBLE, counts BIGINT."""

from __future__ import annotations

# Fixed values restated in SQL for the independent oracle: month names and
# their quarters (as in clientlens.schema), the age-group edges 30 and 60,
# 5-year and 10-year band widths.
_MONTH = "lower(strftime(o_orderdate, '%b'))"

def _rounded(num: str, den: str, digits: int) -> str:
    """num / den (whole numbers) rounded half away from zero to ``digits``
    decimals, by HUGEINT arithmetic."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    return (f"CASE WHEN {num} < 0 THEN -1 ELSE 1 END"
            f" * CAST((2 * abs({n}) * {10 ** digits} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** digits}")


def _fpm(col: str, digits: int = 2, scale: int = 2) -> str:
    """Exact decimal mean, rounded half away from zero."""
    total = f"(SUM(CAST({col} AS DECIMAL(18,{scale}))) * {10 ** scale})"
    return _rounded(total, f"(COUNT({col}) * {10 ** scale})", digits)


def _pct(hits: str, total: str = "count(*)", digits: int = 2) -> str:
    """Percentage of two counts, rounded half away from zero."""
    return _rounded(f"(({hits}) * 100)", total, digits)


_RATE_F = _pct("count(*) FILTER (WHERE o_orderstatus = 'F')")

_AGE_GROUP = ("CASE WHEN {c} IS NULL THEN 'unknown' WHEN {c} < 30 THEN '<30'"
              " WHEN {c} <= 60 THEN '30-60' ELSE '>60' END")

_BAND5 = ("CAST(CAST(floor(l_quantity / 5) * 5 AS BIGINT) AS VARCHAR) || '-' ||"
          " CAST(CAST(floor(l_quantity / 5) * 5 AS BIGINT) + 4 AS VARCHAR)")

_QUARTER = ("CASE month WHEN 'jan' THEN 'Q1' WHEN 'feb' THEN 'Q1' WHEN 'mar' THEN 'Q1'"
            " WHEN 'apr' THEN 'Q2' WHEN 'may' THEN 'Q2' WHEN 'jun' THEN 'Q2'"
            " WHEN 'jul' THEN 'Q3' WHEN 'aug' THEN 'Q3' WHEN 'sep' THEN 'Q3'"
            " WHEN 'oct' THEN 'Q4' WHEN 'nov' THEN 'Q4' WHEN 'dec' THEN 'Q4' END")

_MONTHS_VALUES = ("(VALUES ('jan', 1), ('feb', 2), ('mar', 3), ('apr', 4), ('may', 5),"
                  " ('jun', 6), ('jul', 7), ('aug', 8), ('sep', 9), ('oct', 10),"
                  " ('nov', 11), ('dec', 12)) AS m(month, month_num)")


_ODD_MONTHS = (f"SELECT CASE WHEN o_orderkey % 89 = 0 OR {_MONTH} = 'feb' THEN 'zzz' WHEN o_orderkey % 97 = 0 THEN NULL ELSE {_MONTH} END AS month"
               " FROM orders")


def _describe(col: str, scale: int) -> str:
    return (f"SELECT '{col}' AS column_name, count({col}) AS count,"
            f" {_fpm(col, 4, scale)} AS mean, ROUND(stddev_samp({col}), 4) AS stddev,"
            f" CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max"
            " FROM lineitem")


def _nulls(cols: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count"
        f" FROM {table}" for c in cols)


BATCH_SQL = {
    "total_count": "SELECT count(*) AS total_rows FROM lineitem",
    "partition_stats": """
        SELECT CAST(8 AS BIGINT) AS partitions, count(*) AS row_count, CAST(0 AS BIGINT) AS split_keys FROM lineitem""",
    "avg_median_sketch": """
        SELECT l_returnflag, count(l_extendedprice) AS row_count, true AS rank_error_ok FROM lineitem GROUP BY 1""",
    "kll_quantiles": """
        SELECT l_returnflag, count(l_extendedprice) AS row_count, true AS rank_error_ok, count(l_extendedprice) AS sketched,
               CAST(min(l_extendedprice) AS DOUBLE) AS min_price, CAST(max(l_extendedprice) AS DOUBLE) AS max_price
        FROM lineitem GROUP BY 1""",
    "winsorize_sketch": """
        SELECT count(value) AS row_count, true AS rank_error_ok, CAST(0 AS BIGINT) AS outside FROM events""",
    "preview": """
        SELECT * FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        LIMIT 10""",
    "count_by": """
        SELECT l_returnflag, l_linestatus, count(*) AS row_count
        FROM lineitem GROUP BY l_returnflag, l_linestatus
        ORDER BY l_returnflag, l_linestatus""",
    "filter_conj": "SELECT * FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'",
    "filter_threshold": "SELECT count(*) AS high_balance_count FROM customer WHERE c_acctbal > 1000",
    "topk_rows": """
        SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal FROM customer
        ORDER BY c_acctbal DESC, c_custkey LIMIT 10""",
    "topk_frequent": """
        SELECT l_partkey, count(*) AS row_count FROM lineitem GROUP BY l_partkey
        ORDER BY row_count DESC, l_partkey LIMIT 5""",
    "avg_by_group": f"""
        SELECT l_returnflag, {_fpm('l_extendedprice')} AS avg_extendedprice,
               count(*) AS row_count
        FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag""",
    "avg_by_group_two_keys": f"""
        SELECT l_returnflag, l_linestatus, {_fpm('l_quantity', 2, 0)} AS avg_quantity,
               count(*) AS row_count
        FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_returnflag, l_linestatus""",
    "avg_median_by_group": f"""
        SELECT l_returnflag, {_fpm('l_extendedprice')} AS avg_extendedprice,
               quantile_disc(l_quantity, 0.5) AS median_quantity, count(*) AS row_count
        FROM lineitem GROUP BY l_returnflag""",
    "filtered_count_by_group": """
        SELECT o_orderpriority, count(*) AS finished_count FROM orders
        WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""",
    "rate_by_group": f"""
        SELECT o_orderpriority, count(*) AS total_orders,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS finished_orders,
               {_RATE_F} AS finished_rate_pct
        FROM orders GROUP BY o_orderpriority""",
    "topk_rate": f"""
        SELECT c_nationkey, count(*) AS total_customers,
               count(*) FILTER (WHERE c_acctbal > 5000) AS rich_customers,
               {_pct("count(*) FILTER (WHERE c_acctbal > 5000)")} AS rich_rate_pct
        FROM customer GROUP BY c_nationkey
        ORDER BY rich_rate_pct DESC, c_nationkey LIMIT 3""",
    "topk_avg_with_rate": f"""
        SELECT o_custkey, {_fpm('o_totalprice')} AS avg_totalprice,
               {_RATE_F} AS finished_rate_pct
        FROM orders GROUP BY o_custkey
        ORDER BY avg_totalprice DESC, o_custkey LIMIT 5""",
    "busiest_month": f"""
        SELECT month, count(*) AS total_contacts, {_RATE_F} AS success_rate_pct
        FROM (SELECT {_MONTH} AS month, o_orderstatus FROM orders)
        GROUP BY month ORDER BY total_contacts DESC, month LIMIT 1""",
    "monthly_trend": f"""
        SELECT m.month, m.month_num, coalesce(c.contact_volume, 0) AS contact_volume, c.month IS NULL AS is_absent
        FROM {_MONTHS_VALUES}
        LEFT JOIN (SELECT month, count(*) AS contact_volume
                   FROM ({_ODD_MONTHS}) GROUP BY 1) c ON c.month = m.month
        ORDER BY m.month_num""",
    "month_quarter": f"""
        SELECT DISTINCT month, {_QUARTER} AS quarter
        FROM ({_ODD_MONTHS}) ORDER BY month""",
    "avg_by_quarter": f"""
        SELECT {_QUARTER} AS quarter, {_fpm('o_totalprice')} AS avg_totalprice
        FROM (SELECT {_MONTH} AS month, o_totalprice FROM orders)
        GROUP BY 1 ORDER BY 1""",
    "month_status_crosstab": f"""
        SELECT month,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS yes_count,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS no_count,
               count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS total
        FROM (SELECT {_MONTH} AS month, o_orderstatus FROM orders) GROUP BY month""",
    "pivot_counts": """
        SELECT l_returnflag,
               count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
               count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
        FROM (SELECT l_returnflag, CASE WHEN l_returnflag = 'R' THEN 'F' ELSE l_linestatus END AS l_linestatus FROM lineitem)
        GROUP BY l_returnflag ORDER BY l_returnflag""",
    "partition_rows": """
        SELECT CAST(p AS INTEGER) AS partition_id, count(l_linenumber) AS row_count
        FROM range(10) AS r(p) LEFT JOIN lineitem ON l_linenumber % 10 = p GROUP BY p""",
    "age_band5": f"""
        SELECT {_BAND5} AS band, count(*) AS row_count FROM lineitem
        GROUP BY 1 ORDER BY 1""",
    "topk_band_avg": f"""
        SELECT {_BAND5} AS band, {_fpm('l_extendedprice')} AS avg_extendedprice,
               count(*) AS row_count
        FROM lineitem WHERE l_returnflag = 'R'
        GROUP BY 1 ORDER BY avg_extendedprice DESC, band LIMIT 5""",
    "age_group": f"""
        SELECT {_AGE_GROUP.format(c='age')} AS age_group, count(*) AS row_count
        FROM (SELECT CASE WHEN event_id % 97 <> 0 THEN user_id END AS age FROM events) GROUP BY 1""",
    "band_stats": f"""
        SELECT CAST(CAST(floor(user_id / 10) * 10 AS BIGINT) AS VARCHAR) || 's' AS band,
               {_fpm('value')} AS avg_value, count(*) AS row_count,
               min(value) AS min_value, max(value) AS max_value
        FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL
        GROUP BY 1 ORDER BY 1""",
    "corr": "SELECT ROUND(corr(l_quantity, l_extendedprice), 6) AS corr_quantity_price FROM lineitem",
    "spread_by_group": f"""
        SELECT l_returnflag, {_fpm('l_extendedprice')} AS avg_price,
               ROUND(stddev_pop(l_extendedprice), 2) AS stddev_price,
               min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
        FROM lineitem GROUP BY l_returnflag""",
    "describe_numeric": " UNION ALL ".join(
        _describe(c, sc) for c, sc in
        [("l_quantity", 0), ("l_extendedprice", 2), ("l_discount", 2), ("l_tax", 2)]),
    "null_counts": _nulls(["event_id", "ts", "user_id", "event_type", "value", "props"],
                          "(SELECT event_id, ts, CASE WHEN event_id % 89 <> 0 THEN user_id END AS user_id, event_type,"
                          " CASE WHEN event_id % 97 <> 0 THEN value END AS value, props FROM events)"),
    "global_metrics": f"""
        SELECT {_fpm('o_totalprice')} AS avg_totalprice,
               {_RATE_F} AS finished_pct,
               count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_count
        FROM orders""",
    "winsorize_iqr": """
        WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
                   FROM events),
             f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
        SELECT event_id, value,
               CASE WHEN value < (SELECT lo FROM f) THEN (SELECT lo FROM f)
                    WHEN value > (SELECT hi FROM f) THEN (SELECT hi FROM f)
                    ELSE value END AS value_clipped
        FROM events""",
    "exact_quantiles": " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, quantile_disc(l_extendedprice, {p}) AS value"
        " FROM lineitem" for p in [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]),
    "exact_median_by_group": """
        SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_returnflag END AS l_returnflag,
               quantile_disc(l_extendedprice, 0.5) AS median_extendedprice
        FROM lineitem GROUP BY 1""",
    "replace_sentinel": """
        SELECT o_orderkey, CAST(CASE WHEN g = -1 THEN 0 ELSE g END AS INTEGER) AS contact_gap
        FROM (SELECT o_orderkey,
                     CASE WHEN ((o_custkey % 10) + 10) % 10 = 0 THEN -1
                          ELSE ((o_custkey % 10) + 10) % 10 END AS g
              FROM orders)""",
    "string_features": """
        SELECT c_custkey, concat_ws('_', c_mktsegment, c_name) AS segment_name,
               upper(c_name) AS name_upper
        FROM customer""",
    "above_avg_by_group": """
        SELECT c_mktsegment, count(*) AS client_count FROM customer
        WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) AND c_nationkey < 10
        GROUP BY c_mktsegment""",
    "sql_view_agg": f"""
        SELECT {_AGE_GROUP.format(c='l_quantity')} AS age_group, count(*) AS row_count,
               ROUND(avg(l_extendedprice), 2) AS avg_extendedprice
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "with_event_time": """
        SELECT event_id, event_id % 50 <> 0 AS kept, event_id % 50 = 0 AS is_processing_time FROM events""",
}


def _sliding(window_s: int, slide_s: int, keys: str = "", events: str = "events", rows: str = "true") -> str:
    """Sliding windows over a relation with ``ts``; ``rows`` filters the
    (event, window) pairs."""
    n = window_s // slide_s
    key_sel = f"{keys}, " if keys else ""
    return f"""
        WITH w AS (
            SELECT time_bucket(INTERVAL {slide_s} SECOND, ts, TIMESTAMP '1970-01-01')
                     - k * INTERVAL {slide_s} SECOND AS window_start,
                   {key_sel}value, second, watermark
            FROM {events if events != 'events' else '(SELECT *, false AS second, NULL AS watermark FROM events)'}, range({n}) AS r(k))
        SELECT window_start, window_start + INTERVAL {window_s} SECOND AS window_end,
               {key_sel}count(*) AS event_count, {_fpm('value', 4, 2)} AS avg_value
        FROM w WHERE {rows.format(end=f"window_start + INTERVAL {window_s} SECOND")} GROUP BY window_start, {key_sel.rstrip(', ') + ', ' if keys else ''}2"""


STREAM_SQL = {
    "stream_source": "SELECT * FROM events",
    "stream_group_agg": f"""
        SELECT event_type, {_fpm('value')} AS avg_value, count(*) AS event_count
        FROM events GROUP BY event_type""",
    "stream_sliding": _sliding(60, 10),
    "stream_watermark": _sliding(60, 30, "event_type", """(
        SELECT e.*, ts < third AND event_id % 20 = 0 AS second,
               max(ts) FILTER (WHERE ts < third AND event_id % 20 <> 0) OVER () - INTERVAL 30 SECOND AS watermark
        FROM events e, (SELECT min(ts) + (max(ts) - min(ts)) / 3 AS third FROM events))""",
                                 "NOT second OR {end} > watermark"),
    "stream_missing_time": """
        SELECT event_id % 50 = 0 AS is_now, count(*) AS event_count FROM events GROUP BY 1""",
    "stream_state": """
        WITH e AS (SELECT *, max(ts) OVER () - INTERVAL 30 SECOND AS watermark FROM events),
        w AS (SELECT time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 30 SECOND AS window_start,
                     event_type, watermark
              FROM e, range(2) AS r(k))
        SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, event_type, count(*) AS event_count
        FROM w WHERE window_start + INTERVAL 60 SECOND > watermark GROUP BY window_start, event_type, watermark""",
    "stream_upsert": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_feed": """
        SELECT *, (row_number() OVER (ORDER BY s_suppkey) - 1) // 50 AS batch FROM supplier""",
    "stream_memory": """
        SELECT event_type, count(*) AS event_count FROM events GROUP BY 1""",
    "stream_concurrent": """
        SELECT unnest(['job_aggregation', 'window_analysis', 'watermark_query']) AS query,
               unnest([count(*), 6 * count(*), 2 * count(*)]) AS events, true AS stopped FROM events""",
}


_RULES = """
    SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS label,
           CAST(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
           l_discount AS score
    FROM lineitem"""

_BUCKET = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"
_MODEL_CLIENTS = f"""
    SELECT o_orderkey, o_orderpriority, {_MONTH} AS month,
           CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS price, year(o_orderdate) AS yr,
           o_custkey % 10 AS gap, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
           {_BUCKET} < 80 AS train FROM orders"""


def _slots(column: str) -> str:
    """Known values of a category with their place (most frequent first) and
    the sample deviation of their 0/1 slot over the training rows."""
    return (f"(SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS place,"
            f" sqrt((count(*) - count(*) * count(*) / any_value(total)) / (any_value(total) - 1)) AS dev"
            f" FROM c, (SELECT count(*) AS total FROM c WHERE train) WHERE train GROUP BY {column})")


_TREE = f"""
        WITH c AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 < CASE WHEN yr >= 1998 THEN 7 ELSE 2 END THEN 1 ELSE 0 END AS label)
                   FROM ({_MODEL_CLIENTS})),
             f AS (SELECT yr AS x, label, 'yr' AS of FROM c WHERE train UNION ALL SELECT gap, label, 'gap' FROM c WHERE train),
             v AS (SELECT of, x, lead(x) OVER (PARTITION BY of ORDER BY x) AS nx FROM (SELECT DISTINCT of, x FROM f)),
             s AS (SELECT v.of, (v.x + nx) / 2.0 AS cut, count(*) FILTER (f.x <= v.x) AS nl, sum(label) FILTER (f.x <= v.x) AS pl,
                          count(*) FILTER (f.x > v.x) AS nr, sum(label) FILTER (f.x > v.x) AS pr
                   FROM v JOIN f USING (of) WHERE nx IS NOT NULL GROUP BY ALL),
             b AS (SELECT *, pl / nl AS low, pr / nr AS high FROM s
                   ORDER BY 2 * pl * (nl - pl) / nl + 2 * pr * (nr - pr) / nr LIMIT 1)"""

_TREE_SCORES = f"""{_TREE},
             l AS (SELECT o_orderkey, CASE WHEN (CASE of WHEN 'yr' THEN yr ELSE gap END) <= cut THEN low ELSE high END AS p FROM c, b)
        SELECT o_orderkey, CAST(p > 0.5 AS INTEGER) AS prediction, round(p, 6) AS confidence FROM l"""


MODEL_SQL = {
    "hash_split": f"""
        SELECT CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS row_count
        FROM orders GROUP BY 1""",
    "feature_vectors": f"""
        WITH c AS ({_MODEL_CLIENTS}),
             q AS (SELECT quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.5) AS q2,
                          quantile_disc(price, 0.75) AS q3 FROM c WHERE train),
             n AS (SELECT c.*, least(greatest(coalesce(price, q2), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS x
                   FROM c, q),
             d AS (SELECT stddev_samp(x) AS dx, stddev_samp(yr) AS dy, stddev_samp(gap) AS dg FROM n WHERE train),
             p AS {_slots('o_orderpriority')},
             m AS {_slots('month')},
             pl AS (SELECT list(place ORDER BY place) AS places FROM p),
             ml AS (SELECT list(place ORDER BY place) AS places FROM m)
        SELECT o_orderkey, CAST(label AS INTEGER) AS label,
               array_to_string(list_concat(
                   list_transform(pl.places, lambda i: CASE WHEN i = p.place AND p.dev > 0 THEN CAST(round(1e6 / p.dev) AS BIGINT) ELSE 0 END),
                   list_transform(ml.places, lambda i: CASE WHEN i = m.place AND m.dev > 0 THEN CAST(round(1e6 / m.dev) AS BIGINT) ELSE 0 END),
                   [CAST(round(x / dx * 1e6) AS BIGINT), CAST(round(yr / dy * 1e6) AS BIGINT), CAST(round(gap / dg * 1e6) AS BIGINT)]), ',') AS features
        FROM n LEFT JOIN p ON n.o_orderpriority = p.v LEFT JOIN m ON n.month = m.v, d, pl, ml""",
    "score_clients": """
        SELECT o_orderpriority, count(*) AS n_scored, count(DISTINCT o_orderkey) AS n_keys,
               CAST(0 AS BIGINT) AS n_invalid FROM orders GROUP BY 1""",
    "stream_score": """
        SELECT count(*) AS n_streamed, count(*) AS n_batch, count(DISTINCT o_orderkey) AS n_keys,
               CAST(0 AS BIGINT) AS n_different FROM orders""",
    "tune_rf": """
        SELECT CAST(t AS INTEGER) AS num_trees, CAST(d AS INTEGER) AS max_depth, true AS auc_in_range, true AS best_is_tested
        FROM (VALUES (50), (100)) AS a(t), (VALUES (4), (6)) AS b(d)""",
    "feature_importance": f"""
        WITH c AS ({_MODEL_CLIENTS})
        SELECT unnest(['o_orderpriority', 'month', 'o_totalprice', 'order_year', 'contact_gap']) AS feature,
               unnest([count(DISTINCT o_orderpriority), count(DISTINCT month), 1, 1, 1]) AS n_slots,
               true AS in_range, CAST(1 AS DOUBLE) AS total FROM c WHERE train""",
    "string_index": """
        WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
             r AS (SELECT o_orderpriority,
                          CAST(row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS DOUBLE)
                            AS priority_index
                   FROM c)
        SELECT o.o_orderkey, o.o_orderpriority, r.priority_index
        FROM orders o JOIN r ON o.o_orderpriority = r.o_orderpriority""",
    "dictionary_index": """
        WITH c AS (SELECT o_clerk_group, count(*) AS n FROM (SELECT o_custkey % 1000 AS o_clerk_group FROM orders WHERE o_orderkey % 5 > 0) GROUP BY 1),
             r AS (SELECT o_clerk_group, CAST(row_number() OVER (ORDER BY n DESC, o_clerk_group) - 1 AS DOUBLE) AS clerk_index FROM c)
        SELECT o_orderkey, o_custkey % 1000 AS o_clerk_group, coalesce(clerk_index, (SELECT CAST(count(*) AS DOUBLE) FROM c)) AS clerk_index
        FROM orders LEFT JOIN r ON o_custkey % 1000 = r.o_clerk_group""",
    "tree_split": _TREE_SCORES,
    "tree_split_stream": _TREE_SCORES,
    "tree_importance": f"""{_TREE}
        SELECT n.feature, CAST(CASE WHEN n.of = b.of THEN 1 ELSE 0 END AS DOUBLE) AS importance,
               CAST(row_number() OVER (ORDER BY n.of = b.of DESC, n.feature) AS INTEGER) AS rank
        FROM (VALUES ('order_year', 'yr'), ('contact_gap', 'gap')) AS n(feature, of), b""",
    "standard_scale": """
        SELECT l_orderkey, l_linenumber,
               ROUND(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6)
                 AS quantity_scaled
        FROM lineitem""",
    "confusion_matrix": f"""
        SELECT label, prediction, count(*) AS row_count FROM ({_RULES}) GROUP BY 1, 2""",
    "class_metrics": f"""
        WITH p AS ({_RULES}),
             cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p),
             per AS (SELECT c,
                            (SELECT count(*) FROM p WHERE label = c) AS actual,
                            (SELECT count(*) FROM p WHERE prediction = c) AS predicted,
                            (SELECT count(*) FROM p WHERE label = c AND prediction = c) AS tp
                     FROM cls),
             m AS (SELECT actual, tp,
                          CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
                          CASE WHEN actual > 0 THEN tp / actual ELSE 0.0 END AS rc
                   FROM per)
        SELECT ROUND(sum(tp) / sum(actual), 6) AS accuracy,
               ROUND(sum(actual * pr) / sum(actual), 6) AS weighted_precision,
               ROUND(sum(actual * rc) / sum(actual), 6) AS weighted_recall,
               ROUND(sum(actual * CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END)
                     / sum(actual), 6) AS weighted_f1
        FROM m""",
    "binary_metrics": f"""
        WITH p AS ({_RULES}),
             r AS (SELECT label,
                          (2 * rank() OVER (ORDER BY score)
                           + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS midrank
                   FROM p),
             s AS (SELECT count(*) FILTER (WHERE label = 1.0) AS pos,
                          count(*) FILTER (WHERE label = 0.0) AS neg,
                          sum(midrank) FILTER (WHERE label = 1.0) AS rank_sum
                   FROM r)
        SELECT ROUND((rank_sum - pos * (pos + 1) / 2.0) / (CAST(pos AS DOUBLE) * neg), 6) AS auc_roc,
               pos AS positives, neg AS negatives
        FROM s""",
}


IO_SQL = {
    "load_clients": "SELECT * FROM customer",
    "write_chunks": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate
        FROM orders""",
    "clean_rows": f"""
        SELECT o_orderpriority, {_fpm('o_totalprice')} AS avg_totalprice,
               count(*) AS row_count
        FROM orders WHERE o_totalprice IS NOT NULL AND o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0
        GROUP BY o_orderpriority""",
    "ingest_table": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
    "bucketed_group": f"""
        SELECT o_custkey, {_fpm('o_totalprice')} AS avg_totalprice, count(*) AS order_count
        FROM orders GROUP BY o_custkey""",
    "observed_write": f"""
        SELECT count(*) AS row_count, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_o_orderkey,
               count(*) FILTER (WHERE o_totalprice IS NULL) AS null_o_totalprice,
               count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderkey % 50 = 0) AS null_o_orderpriority,
               {_fpm('o_totalprice')} AS avg_totalprice
        FROM orders""",
    "shared_scan": """
        SELECT 'priority' AS report, o_orderpriority AS key, count(*) AS row_count FROM orders GROUP BY 2
        UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY 2""",
    "csv_table": "SELECT o_orderstatus, count(*) AS row_count, min(o_orderkey) AS first_key FROM orders GROUP BY 1",
    "load_renamed": """
        SELECT c_custkey AS client_id, c_mktsegment AS job, c_acctbal FROM customer""",
    "write_tsv": f"""
        SELECT c_mktsegment, {_fpm('c_acctbal')} AS avg_acctbal, count(*) AS client_count
        FROM customer WHERE c_acctbal IS NOT NULL GROUP BY c_mktsegment""",
}
