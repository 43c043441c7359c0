"""DuckDB oracle SQL, one SELECT per registered query.

Each text runs on DuckDB over the raw views (``lineitem``, ``orders``,
``part``, ``events``) and re-derives the fixture tables itself, so Spark and
DuckDB share only the parquet files. Column names equal the Spark output
names; money is DECIMAL(38,2) in both; every ORDER BY spells out NULLS
FIRST/LAST and the same tie-break order as ``tidemart.operators.latest``.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..sources.fixtures import ORDER_ITEM_COLUMNS, PRODUCT_COLUMNS
from . import params as P

DIM_COLUMNS = ["id", "brand", "department", "category", "updated_at"]

# Fixture mapping in DuckDB dialect (same fixed values as sources.fixtures).
ORDER_ITEMS_SQL = """
SELECT l_orderkey*10 + l_linenumber AS id, l_orderkey AS order_id, o_custkey AS user_id,
       l_partkey AS product_id, l_suppkey AS inventory_item_id,
       CASE WHEN l_returnflag='R' THEN 'Returned' WHEN l_linestatus='F' THEN 'Complete'
            ELSE 'Processing' END AS status,
       c AS created_at,
       CASE WHEN l_linestatus='F' OR l_returnflag='R' THEN c + INTERVAL 1 DAY END AS shipped_at,
       CASE WHEN l_linestatus='F' OR l_returnflag='R' THEN c + INTERVAL 4 DAY END AS delivered_at,
       CASE WHEN l_returnflag='R' THEN c + INTERVAL 14 DAY END AS returned_at,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sale_price
FROM (SELECT lineitem.*, o_custkey,
             l_shipdate + to_seconds(CAST((l_partkey*7919 + l_suppkey*104729
                                           + l_linenumber*15485) % 86400 AS BIGINT)) AS c
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
"""

PRODUCTS_DELTA_SQL = """
SELECT p_partkey AS id, p_retailprice*0.5 AS cost, p_type AS category, p_name AS name,
       'Brand#' || CAST((p_partkey+7*v)%25 AS VARCHAR) AS brand,
       p_retailprice AS retail_price,
       CASE WHEN (p_partkey+v)%2=0 THEN 'Women' ELSE 'Men' END AS department,
       'SKU' || CAST(p_partkey AS VARCHAR) AS sku, p_partkey%10+1 AS distribution_center_id,
       TIMESTAMP '1995-01-01 00:00:00'
         + to_days(CAST((p_partkey*131 + (v%3)*797) % 2400 AS INTEGER))
         + to_hours(CAST(v*5 AS BIGINT)) AS updated_at
FROM (SELECT *, CAST(unnest([0, 1, 2, 3]) AS BIGINT) AS v FROM part) p
"""


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def latest(src: str, partition: str, stamp: str, columns: Sequence[str],
           keys: Sequence[str], out: Sequence[str] | None = None) -> str:
    """Keep-latest with the library's tie-break (other columns, DESC NULLS LAST)."""
    tiebreak = [c for c in columns if c not in keys and c != stamp]
    order = ", ".join([f"{stamp} DESC NULLS LAST"] + [f"{c} DESC NULLS LAST" for c in tiebreak])
    cols = ", ".join(out or columns)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {partition} "
            f"ORDER BY {order}) AS rn__ FROM ({src}) s) r WHERE rn__ = 1")


def with_(ctes: dict[str, str], body: str) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


OI = {"order_items_delta": ORDER_ITEMS_SQL}
PD = {"products_delta": PRODUCTS_DELTA_SQL}
FACT_SQL = latest("SELECT * FROM order_items_delta", "id, CAST(created_at AS DATE)", "created_at",
                  ORDER_ITEM_COLUMNS, ["id"])
DIM_DAILY_SQL = latest("SELECT * FROM products_delta", "id, CAST(updated_at AS DATE)", "updated_at",
                       PRODUCT_COLUMNS, ["id"], DIM_COLUMNS)
MAIN_SQL = latest(f"SELECT * FROM products_delta WHERE updated_at < {ts('1996-06-01 00:00:00')}",
                  "id", "updated_at", PRODUCT_COLUMNS, ["id"])
NTH_SQL = ("SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at) AS nth FROM products_delta) n "
           "WHERE nth = {nth}")
IMAGE_SQL = NTH_SQL.format(cols=", ".join(PRODUCT_COLUMNS), nth="id // 4 % 4 + 1 AND id % 10 <> 0")
CHANGES_SQL = NTH_SQL.format(cols=", ".join(PRODUCT_COLUMNS), nth="id % 4 + 1")
PAIR = {**PD, "image": IMAGE_SQL, "changes": CHANGES_SQL}


def merge_sql(target: str, source: str, columns: Sequence[str], key: str = "id",
              version: str | None = None, update: Sequence[str] | None = None) -> str:
    """MERGE as a full outer join: insert new keys, update matched rows
    (only when target.version < source.version if guarded)."""
    update = [c for c in (update or columns) if c != key]
    allow = "TRUE" if version is None else f"COALESCE(t.{version} < s.{version}, FALSE)"
    take = f"(t.{key} IS NULL OR ({allow}))"
    cols = []
    for c in columns:
        if c == key:
            cols.append(f"CASE WHEN t.{key} IS NULL THEN s.{key} ELSE t.{key} END AS {c}")
        elif c in update:
            cols.append(f"CASE WHEN s.{key} IS NOT NULL AND {take} THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t.{key} IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    return (f"SELECT {', '.join(cols)} FROM ({target}) t FULL OUTER JOIN ({source}) s "
            f"ON t.{key} = s.{key}")


def _day_range(start: str, end: str, column: str) -> str:
    return f"CAST({column} AS DATE) >= DATE '{start}' AND CAST({column} AS DATE) < DATE '{end}'"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    oi_pd = {**OI, **PD}

    q["snapshot_extract"] = with_(OI, "SELECT * FROM order_items_delta")
    q["snapshot_extract_products"] = with_(PD, latest("SELECT * FROM products_delta", "id", "updated_at", PRODUCT_COLUMNS, ["id"]))
    q["stream_ingest"] = with_(PD, "SELECT * FROM products_delta")
    runs = " OR ".join(f"(created_at >= date_trunc('hour', {ts(t)}) - INTERVAL {h} HOUR AND created_at < date_trunc('hour', {ts(t)}))"
                       for t, h in P.HOURLY_RUNS)
    q["hourly_change_load"] = with_(OI, f"SELECT * FROM order_items_delta WHERE {runs}")
    cols = ", ".join(c for c in ORDER_ITEM_COLUMNS if c != "sale_price")
    q["checked_load"] = with_({**OI, "fact": FACT_SQL}, f"""
        SELECT {cols}, CAST(sale_price + CASE WHEN {_day_range(*P.CHECKED_DAYS, 'created_at')} THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS sale_price
        FROM fact""")
    # every row of the windows that is visible by the last run
    first = min(P.LATE_RUNS)
    q["late_change_load"] = with_(OI, f"""
        SELECT * FROM order_items_delta
        WHERE created_at >= {ts(first)} - INTERVAL {P.LATE_WINDOW + P.LATE_HOURS + 1} HOUR AND created_at < {ts(max(P.LATE_RUNS))}
          AND created_at + to_hours(CASE WHEN id % 5 = 0 THEN id % {P.LATE_HOURS} + 1 ELSE 0 END) <= {ts(max(P.LATE_RUNS))}""")
    q["cdc_window_products"] = with_(PD, f"""
        SELECT *, strftime(date_trunc('hour', updated_at), '%Y-%m-%d') AS load_date,
               strftime(date_trunc('hour', updated_at), '%H:%M:%S') AS load_hour
        FROM products_delta
        WHERE updated_at >= {ts(P.PRODUCT_CDC_WINDOW[0])} AND updated_at < {ts(P.PRODUCT_CDC_WINDOW[1])}""")
    q["cdc_window_order_items"] = with_(OI, f"""
        SELECT *, strftime(date_trunc('hour', created_at), '%Y-%m-%d') AS load_date,
               strftime(date_trunc('hour', created_at), '%H:%M:%S') AS load_hour
        FROM order_items_delta
        WHERE created_at >= {ts(P.ORDER_CDC_WINDOW[0])} AND created_at < {ts(P.ORDER_CDC_WINDOW[1])}""")
    q["hour_bucket"] = """
        SELECT event_id, ts AS run_time,
               date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start,
               date_trunc('hour', ts) AS window_end,
               strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%Y-%m-%d') || '/'
                 || strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%H:%M:%S') AS load_prefix
        FROM events"""
    q["source_passthrough"] = with_(OI, "SELECT * FROM order_items_delta")
    q["type_policy"] = """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               l_shipdate
        FROM lineitem"""
    q["view_filter"] = with_(OI, f"SELECT * FROM order_items_delta WHERE status = '{P.RETURNED_STATUS}'")
    q["select_except"] = with_(OI, "SELECT * EXCLUDE (inventory_item_id, status) FROM order_items_delta")
    q["day_filter"] = with_(OI, f"SELECT * FROM order_items_delta WHERE CAST(created_at AS DATE) = DATE '{P.DAY}'")
    q["day_lower_bound"] = with_(PD, f"SELECT * FROM products_delta WHERE CAST(updated_at AS DATE) >= DATE '{P.LOWER_DAY}'")
    dim_cols = ", ".join(DIM_COLUMNS)
    q["scope_filter"] = with_(PD, f"""
        SELECT 'explicit' AS scope, {dim_cols} FROM products_delta
          WHERE CAST(updated_at AS DATE) = DATE '{P.SCOPE_DAY}'
        UNION ALL
        SELECT 'incremental' AS scope, {dim_cols} FROM products_delta
          WHERE CAST(updated_at AS DATE) = DATE '{P.SCOPE_AS_OF}' - INTERVAL 1 DAY
        UNION ALL
        SELECT 'full' AS scope, {dim_cols} FROM products_delta
          WHERE CAST(updated_at AS DATE) >= DATE '{P.SCOPE_FIRST_DAY}'""")

    asof_body = """
        SELECT f.*, d.category, d.brand, d.department, d.updated_at AS version_updated_at
        FROM fact f ASOF LEFT JOIN dim d ON f.product_id = d.id AND f.created_at >= d.updated_at"""
    q["asof_join"] = with_({**oi_pd, "fact": FACT_SQL, "dim": DIM_DAILY_SQL}, asof_body)
    q["asof_join_union"] = q["asof_join"]
    q["asof_events"] = """
        WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
             v AS (SELECT * FROM events WHERE event_type = 'view')
        SELECT p.event_id, p.user_id, p.ts, p.value,
               v.event_id AS view_event_id, v.ts AS view_ts
        FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts"""

    q["merge_guarded"] = with_(PAIR, merge_sql("SELECT * FROM image", "SELECT * FROM changes", PRODUCT_COLUMNS, version="updated_at"))
    q["merge_unguarded"] = with_(PAIR, merge_sql("SELECT * FROM image", "SELECT * FROM changes", PRODUCT_COLUMNS))
    in_window = f"updated_at >= {ts(P.PRODUCT_CDC_WINDOW[0])} AND updated_at < {ts(P.PRODUCT_CDC_WINDOW[1])}"
    q["merge_delta_to_main"] = with_(
        {**PAIR, "src": latest(f"SELECT * FROM products_delta WHERE {in_window}", "id", "updated_at", PRODUCT_COLUMNS, ["id"])},
        merge_sql("SELECT * FROM image", "SELECT * FROM src", PRODUCT_COLUMNS, version="updated_at"))

    q["signed_daily_sum"] = with_({**OI, "fact": FACT_SQL}, """
        SELECT CAST(created_at AS DATE) AS transaction_date,
               CAST(SUM(CASE WHEN returned_at IS NULL THEN sale_price ELSE sale_price * -1 END)
                    AS DECIMAL(38,2)) AS total_sale
        FROM fact GROUP BY 1""")
    q["sales_periodic_fact"] = q["signed_daily_sum"]
    q["sales_by_attributes"] = with_(
        {**oi_pd, "fact": FACT_SQL, "hist": f"SELECT {dim_cols} FROM products_delta"}, """
        SELECT CAST(f.created_at AS DATE) AS transaction_date, h.category, h.brand, h.department,
               CAST(SUM(f.sale_price) AS DECIMAL(38,2)) AS total_sales
        FROM fact f ASOF LEFT JOIN hist h ON f.product_id = h.id AND f.created_at >= h.updated_at
        GROUP BY 1, 2, 3, 4""")
    q["sales_report"] = with_({**oi_pd, "fact": FACT_SQL, "dim": DIM_DAILY_SQL}, """
        SELECT CAST(f.created_at AS DATE) AS transaction_date, d.category, d.brand, d.department,
               CAST(SUM(f.sale_price) AS DECIMAL(38,2)) AS total_sales
        FROM fact f ASOF LEFT JOIN dim d ON f.product_id = d.id AND f.created_at >= d.updated_at
        GROUP BY 1, 2, 3, 4""")

    q["sales_report_daily"] = q["sales_report"]

    q["latest_product_per_day"] = with_(PD, latest(
        "SELECT * FROM products_delta", "id, CAST(updated_at AS DATE)", "updated_at",
        PRODUCT_COLUMNS, ["id"]))
    q["latest_order_item_per_day"] = with_(OI, FACT_SQL)
    q["sales_transaction_fact"] = with_(OI, FACT_SQL)
    q["product_dim_daily"] = with_(PD, DIM_DAILY_SQL)
    q["product_dim_history"] = with_(PD, f"SELECT {dim_cols} FROM products_delta")
    q["product_dim_intervals"] = with_({**PD, "dim": DIM_DAILY_SQL}, """
        SELECT *, updated_at AS valid_from,
               lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at ASC NULLS LAST) AS valid_to,
               lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at ASC NULLS LAST) IS NULL
                 AS is_current
        FROM dim""")
    # H2 + H11: the intervals of the whole history, however its days came in.
    q["product_intervals_incremental"] = with_(PD, f"""
        SELECT {dim_cols}, updated_at AS valid_from,
               lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at ASC NULLS LAST) AS valid_to,
               lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at ASC NULLS LAST) IS NULL
                 AS is_current
        FROM products_delta WHERE updated_at < DATE '{P.HISTORY_END}'""")

    all_cols = ", ".join(f"{c} ASC NULLS LAST" for c in ORDER_ITEM_COLUMNS)
    q["limit_ordered"] = with_(OI, f"SELECT * FROM order_items_delta ORDER BY {all_cols} LIMIT {P.LIMIT_ROWS}")

    # The day's rows are gone, all others kept.
    q["delete_day"] = with_({**OI, "fact": FACT_SQL},
                            f"SELECT * FROM fact WHERE CAST(created_at AS DATE) <> DATE '{P.DAY}'")
    # Raw items everywhere except the reloaded day, which holds the fact.
    q["reload_day"] = with_({**OI, "fact": FACT_SQL}, f"""
        SELECT * FROM order_items_delta WHERE CAST(created_at AS DATE) <> DATE '{P.DAY}'
        UNION ALL
        SELECT * FROM fact WHERE CAST(created_at AS DATE) = DATE '{P.DAY}'""")
    q["replace_partitions"] = with_({**OI, "fact": FACT_SQL}, f"""
        SELECT * FROM order_items_delta WHERE NOT ({_day_range(*P.REPLACE_DAYS, 'created_at')})
        UNION ALL
        SELECT * FROM fact WHERE {_day_range(*P.REPLACE_DAYS, 'created_at')}""")
    q["replace_partitions_empty"] = with_({**OI, "fact": FACT_SQL}, f"""
        SELECT * FROM fact WHERE NOT ({_day_range(*P.EMPTY_DAYS, 'created_at')})""")

    # H1: copy of one image, then the guarded merge of the rows a second image changed on the days.
    q["product_dim_scd1"] = with_(
        {**PAIR, "dim0": f"SELECT {dim_cols} FROM image",
         "changed": f"SELECT {dim_cols} FROM changes WHERE "
                    + _day_range(P.PRODUCT_CDC_WINDOW[0][:10], P.PRODUCT_CDC_WINDOW[1][:10], "updated_at")},
        merge_sql("SELECT * FROM dim0", "SELECT * FROM changed", DIM_COLUMNS, version="updated_at"))
    # H4: first build since the first day, then two unguarded runs.
    q["product_dim_scd1_scoped"] = with_(
        {**PAIR, "dim0": f"SELECT {dim_cols} FROM image WHERE CAST(updated_at AS DATE) >= DATE '{P.SCD_FIRST_DAY}'",
         "changed": f"SELECT {dim_cols} FROM changes WHERE "
                    + _day_range(P.UNGUARDED_WINDOW[0][:10], P.UNGUARDED_WINDOW[1][:10], "updated_at"),
         "dim1": merge_sql("SELECT * FROM dim0", "SELECT * FROM changed", DIM_COLUMNS),
         "yesterday": f"SELECT {dim_cols} FROM changes WHERE CAST(updated_at AS DATE) = DATE '{P.SCD_AS_OF}' - INTERVAL 1 DAY"},
        merge_sql("SELECT * FROM dim1", "SELECT * FROM yesterday", DIM_COLUMNS))

    q["check_unique"] = with_(OI, """
        SELECT unique_field, count(*) AS n_records
        FROM (SELECT id AS unique_field FROM order_items_delta WHERE id IS NOT NULL) t
        GROUP BY unique_field HAVING count(*) > 1""")
    q["check_not_null"] = with_(OI, "SELECT * FROM order_items_delta WHERE shipped_at IS NULL")
    q["stream_upsert_final"] = with_(PD, latest("SELECT * FROM products_delta", "id", "updated_at",
                                                PRODUCT_COLUMNS, ["id"]))
    days = ", ".join(f"DATE '{d}'" for d in P.DATE_LIST)
    q["date_scalars"] = f"""
        SELECT event_id, CAST(ts AS DATE) AS event_date,
               CAST(ts AS DATE) - 1 AS prev_day,
               ts - INTERVAL 1 DAY AS ts_minus_day,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_start,
               date_trunc('year', ts)::TIMESTAMP AS year_trunc, date_trunc('month', ts)::TIMESTAMP AS month_trunc,
               date_trunc('day', ts)::TIMESTAMP AS day_trunc, date_trunc('hour', ts)::TIMESTAMP AS hour_trunc,
               CAST(ts AS DATE) IN ({days}) AS in_days,
               strftime(ts, '%Y-%m-%d') AS day_str
        FROM events"""
    return {k: " ".join(v.split()) for k, v in q.items()}
