"""DuckDB SQL equivalents of the registered queries (views named after the tables).

Column names and types are aliased to match the Spark results exactly.
"""

from __future__ import annotations

# Hopping windows of 60 s every 10 s: a row at time t lies in the six windows that
# start at bucket10(t) - 10 s * k, k = 0..5.
METRICS = """
    SELECT window_start,
           window_start + INTERVAL 60 SECOND AS window_end,
           event_type,
           count(*)                 AS cnt,
           round(sum(value), 2)     AS total,
           round(avg(value), 4)     AS avg_value
    FROM (
        SELECT event_type, value,
               time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k) AS window_start
        FROM events, range(6) AS r(k)
        WHERE ts IS NOT NULL
    )
    GROUP BY window_start, event_type
"""

# What an append-mode stream has emitted after draining: windows whose end passed
# the final watermark (latest event time, in ms, minus 5 s).
STREAMED = f"""
    WITH m AS ({METRICS})
    SELECT * FROM m
    WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 5 SECOND
"""

def _pivot(metric: str, how: str) -> str:
    # DuckDB sums integers to HUGEINT; Spark keeps BIGINT.
    cell = f"{how}({metric}) FILTER (WHERE event_type = '{{t}}')"
    cell = f"CAST({cell} AS BIGINT)" if how == "sum" else cell
    cells = ", ".join(f"{cell.format(t=t)} AS {t}" for t in ("click", "error", "purchase", "signup", "view"))
    return f"""
    WITH m AS ({METRICS})
    SELECT window_end, {cells} FROM m GROUP BY window_end
"""


# Windows of 50 s every 20 s: three a row, of which the last may have ended before it.
PANES = """
    SELECT window_start, window_start + INTERVAL 50 SECOND AS window_end, event_type,
           count(*) AS cnt, round(sum(value), 2) AS total, round(avg(value), 4) AS avg_value
    FROM (
        SELECT event_type, value, ts, time_bucket(INTERVAL 20 SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(20 * k) AS window_start
        FROM events, range(3) AS r(k)
        WHERE ts IS NOT NULL
    )
    WHERE ts < window_start + INTERVAL 50 SECOND
    GROUP BY window_start, event_type
"""

# Pages of a unit are numbered in buckets of 10,000 ids; a bucket's last page may be short.
CAPPED = """
    WITH p AS (SELECT event_type, CAST(ts AS DATE) AS dt, event_id // 10000 AS bucket, count(*) AS n
               FROM events WHERE ts IS NOT NULL GROUP BY ALL),
    b AS (SELECT *, CAST(coalesce(sum(ceil(n / 100)) OVER w, 0) AS BIGINT) AS before
          FROM p WINDOW w AS (PARTITION BY event_type, dt ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    u AS (SELECT event_type, dt, CAST(sum(ceil(n / 100)) AS INTEGER) AS pages_total,
                 CAST(sum(least(n, 100 * greatest(2 - before, 0))) AS BIGINT) AS n_events FROM b GROUP BY ALL),
    d AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS dt FROM events),
    g AS (SELECT * FROM (SELECT DISTINCT event_type FROM events), d)
    SELECT g.event_type, g.dt, CAST(CASE WHEN pages_total IS NULL THEN 0 ELSE least(pages_total, 2) END AS INTEGER) AS pages_fetched,
           coalesce(pages_total > 2, false) AS truncated, CAST(coalesce(pages_total, 0) AS INTEGER) AS pages_total,
           coalesce(n_events, 0) AS n_events
    FROM g LEFT JOIN u ON g.event_type IS NOT DISTINCT FROM u.event_type AND g.dt = u.dt
"""

FLATTEN = {
    "q01_entries_explode": """
        SELECT event_id, j.key AS prop_key, json_extract_string(j.value, '$') AS prop_value
        FROM events, json_each(CAST(props AS JSON)) AS j
    """,
    "q01_rates": """
        SELECT CAST(l_shipdate AS DATE) - 1 AS date, l_returnflag AS currency, 'flag' AS name,
               l_extendedprice AS rate, CAST(trunc(l_quantity) AS INTEGER) AS nominal
        FROM lineitem
        UNION ALL
        SELECT CAST(l_shipdate AS DATE) - 1, l_linestatus, 'status', l_discount, l_linenumber
        FROM lineitem
    """,
    "q02_nested_lists": """
        SELECT CAST(o_orderkey AS VARCHAR)   AS category_id,
               o_orderpriority               AS category_name,
               CAST(l_linenumber AS VARCHAR) AS role_id,
               l_returnflag                  AS role_name,
               l_linestatus = 'O'            AS accept_incomplete_resumes,
               l_discount >= 0.05            AS is_default,
               l_tax >= 0.05                 AS select_deprecated,
               false                         AS search_deprecated
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
    "q02_industries": """
        SELECT CAST(o_orderkey AS VARCHAR) AS industry_group_id, o_orderpriority AS industry_group_name,
               CAST(l_linenumber AS VARCHAR) AS industry_id, l_returnflag AS industry_name
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
    "q03_project": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS uid FROM customer
    """,
    "q04_posting_fields": """
        WITH lc AS (
            SELECT l_orderkey,
                   string_agg(l_linestatus, ',' ORDER BY l_linestatus, l_returnflag) AS ids,
                   string_agg(l_returnflag, ',' ORDER BY l_linestatus, l_returnflag) AS names
            FROM (SELECT DISTINCT l_orderkey, l_linestatus, l_returnflag FROM lineitem) GROUP BY l_orderkey)
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,
               CAST(n_nationkey AS VARCHAR) AS area_id, n_name AS area_name,
               CAST(c_custkey AS VARCHAR) AS employer_id, c_name AS employer_name,
               CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 100) END AS salary_from,
               CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 10) END AS salary_to,
               CASE WHEN o_orderstatus <> 'P' THEN 'USD' END AS salary_currency,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS salary_gross,
               c_mktsegment AS experience_id, c_mktsegment AS experience_name,
               CAST(NULL AS VARCHAR) AS employment_id, CAST(NULL AS VARCHAR) AS employment_name,
               o_orderstatus AS schedule_id, o_orderstatus AS schedule_name,
               CAST(NULL AS VARCHAR) AS type_id, CAST(NULL AS VARCHAR) AS type_name,
               o_orderdate - INTERVAL 3 HOUR AS published_at,
               o_orderdate AS created_at,
               'orders/' || o_orderkey AS alternate_url,
               lc.ids AS professional_role_ids, lc.names AS professional_role_names
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN lc ON lc.l_orderkey = o_orderkey
    """,
    "q05_tree": """
        SELECT 'o' || o_orderkey AS area_id, CAST(NULL AS VARCHAR) AS parent_id, o_orderpriority AS name,
               o_totalprice AS lat, TRY_CAST(o_orderstatus AS DOUBLE) AS lng
        FROM orders
        UNION ALL
        SELECT 'l' || l_orderkey || '-' || l_linenumber, 'o' || l_orderkey, l_returnflag,
               l_quantity, l_discount
        FROM lineitem
        UNION ALL
        SELECT 's' || l_orderkey || '-' || l_linenumber, 'l' || l_orderkey || '-' || l_linenumber,
               l_linestatus, TRY_CAST(l_returnflag AS DOUBLE), l_tax
        FROM lineitem WHERE l_linestatus = 'O'
    """,
    "q06_bundle": """
        SELECT 'lines' AS dict_name, CAST(l_linenumber AS VARCHAR) AS id, l_returnflag AS name FROM lineitem
        UNION ALL
        SELECT 'parts', CAST(NULL AS VARCHAR), l_linestatus FROM lineitem
    """,
    "q07_day_write": """
        SELECT *, DATE '2024-02-01' AS dt FROM customer
    """,
    "q08_day_range": """
        SELECT event_id, ts, user_id, value, props, CAST(ts AS DATE) AS dt, event_type
        FROM events WHERE ts IS NOT NULL
    """,
}


RECENT = f"""
    WITH m AS ({METRICS})
    SELECT * FROM m
    WHERE window_end >= (SELECT max(window_end) FROM m) - INTERVAL 4 HOUR
"""


def oracle_sql() -> dict[str, str]:
    return {
        **FLATTEN,
        "q02_document_files": FLATTEN["q02_nested_lists"],
        "q05_tree_files": FLATTEN["q05_tree"],
        "q08_stream_keyed": FLATTEN["q08_day_range"],
        "q08_resumed_load": """
            WITH e AS (SELECT *, CAST(ts AS DATE) AS dt FROM events WHERE ts IS NOT NULL),
            n AS (SELECT dt, row_number() OVER (ORDER BY dt) AS nth, max(dt) OVER () AS last FROM (SELECT DISTINCT dt FROM e))
            SELECT event_id, ts, user_id, CASE WHEN dt = last AND event_type = 'view' THEN value + 1 ELSE value END AS value, props, dt, event_type,
                   CAST(CASE WHEN dt = last AND event_type = 'view' THEN 3 WHEN nth <= 10 THEN 1 ELSE 2 END AS INTEGER) AS loaded_run
            FROM e JOIN n USING (dt)
        """,
        "q10_panes": PANES,
        "q11_compacted": STREAMED,
        # The fourth landing repeats the first third of the time span, behind the watermark.
        "q11_losses": f"""
            WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
            c AS (SELECT make_timestamp(CAST(epoch_us(lo) + round((epoch_us(hi) - epoch_us(lo)) / 3.0) AS BIGINT)) AS cut FROM b),
            m AS ({METRICS}),
            e AS ({METRICS.replace("FROM events,", "FROM (SELECT * FROM events WHERE ts < (SELECT cut FROM c)),")})
            SELECT window_start, m.window_end, event_type, m.cnt + coalesce(e.cnt, 0) AS landed, m.cnt AS emitted, coalesce(e.cnt, 0) AS lost
            FROM m LEFT JOIN e USING (window_start, event_type)
            WHERE m.window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 5 SECOND
        """,
        "q13_new_files": "SELECT event_id, ts, event_type, value, CAST(event_id % 3 AS INTEGER) AS run FROM events",
        "q14_recent_files": RECENT,
        "q14_recent_metrics": RECENT,
        "q04_merged_postings": """
            WITH r AS (SELECT o_orderkey AS id, o_orderpriority AS name, o_totalprice, CAST(o_orderdate AS DATE) AS day,
                              l_linenumber, l_returnflag || '-' || l_linestatus AS role
                       FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
            v AS (SELECT *, 1 AS version FROM r WHERE l_linenumber % 2 = 1 OR id % 3 = 0
                  UNION ALL SELECT *, 2 FROM r WHERE l_linenumber % 2 = 0 AND id % 5 < 2),
            m AS (SELECT id, max(version) AS version, any_value(name) AS name, any_value(o_totalprice) AS price, any_value(day) AS day,
                         string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM v GROUP BY id)
            SELECT id, CAST(version AS INTEGER) AS version, name, price + version AS salary, roles, CAST(date_trunc('month', day + to_months(CAST(version - 1 AS INTEGER))) AS DATE) AS dt FROM m
        """,
        "q19_paged_capped": CAPPED,
        "q19_paged_predicates": """
            WITH e AS (SELECT *, CAST(ts AS DATE) AS dt FROM events WHERE ts IS NOT NULL),
            b AS (SELECT min(dt) AS lo, max(dt) - min(dt) + 1 AS n FROM e)
            SELECT event_id, ts, user_id, value, props, dt, event_type FROM e, b
            WHERE event_type IN ('click', 'view') AND dt >= lo + CAST(n // 3 AS INTEGER) AND dt < lo + CAST(2 * n // 3 AS INTEGER)
        """,
        "q09_hop_metrics": METRICS,
        "q10_hop_sliced": METRICS,
        "q12_metrics_dedupe": f"""
            WITH m AS ({METRICS}),
            u AS (
                SELECT * FROM m
                UNION ALL SELECT window_start, window_end, event_type, cnt - 1, total, avg_value FROM m
                UNION ALL SELECT window_start, window_end, event_type, cnt, total - 1.0, avg_value FROM m
            )
            SELECT window_start, window_end, event_type, cnt, total, avg_value
            FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY window_start, window_end, event_type
                    ORDER BY cnt DESC, total DESC, avg_value DESC) AS rn
                FROM u)
            WHERE rn = 1
        """,
        "q11_hop_stream": STREAMED,
        "q11_hop_stream_sliced": STREAMED,
        "q11_hop_stream_dirty": STREAMED,
        "q13_metrics_load": METRICS,
        "q13_metrics_dirty": METRICS,
        "q13_listed_types": "SELECT DISTINCT event_type FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL",
        "q14_recent": RECENT,
        "q15_pivot_cnt": _pivot("cnt", "sum"),
        "q15_pivot_avg": _pivot("avg_value", "avg"),
        "q16_totals": f"""
            WITH m AS ({METRICS})
            SELECT event_type, round(sum(total), 2) AS total_sum
            FROM m GROUP BY event_type
        """,
        "q17_kpis": f"""
            WITH m AS ({METRICS})
            SELECT count(*) AS windows,
                   count(DISTINCT event_type) AS event_types,
                   CAST(sum(cnt) AS BIGINT) AS events_weighted,
                   max(window_end) AS last_window_end
            FROM m
        """,
        "q19_paged_source": """
            SELECT event_id, ts, user_id, value, props, CAST(ts AS DATE) AS dt, event_type
            FROM events WHERE ts IS NOT NULL
        """,
        "q19_paged_excluded": """
            SELECT event_id, ts, user_id, value, props, CAST(ts AS DATE) AS dt, event_type
            FROM events WHERE ts IS NOT NULL AND event_type IS DISTINCT FROM 'error'
        """,
        "q20_lake_sql": """
            SELECT c.c_mktsegment AS segment, c.c_nationkey AS nationkey, count(*) AS customers,
                   round(sum(c.c_acctbal), 2) AS acctbal, max(n.n_name) AS nation
            FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
            GROUP BY c.c_mktsegment, c.c_nationkey
        """,
        "q21_kafka_rows": """
            SELECT CAST(event_id AS VARCHAR) AS key, event_type, user_id, value AS amount,
                   epoch_us(ts) // 1000 AS ts_ms, props
            FROM events
        """,
        "q18_latest": f"""
            WITH m AS ({METRICS})
            SELECT window_start, window_end, event_type, cnt, total, avg_value
            FROM m
            ORDER BY window_end DESC, event_type, window_start DESC
            LIMIT 100
        """,
    }
