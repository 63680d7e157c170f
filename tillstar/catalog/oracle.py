"""The same results in plain SQL, written independently of the Spark plans, for DuckDB."""

from __future__ import annotations

from tillstar.catalog.driver_feed import feed_sql_for_oracle

AS_OF = "DATE '2001-10-01'"


def _ratio(num: str, den: str, digits: int) -> str:
    """Round half away from zero on whole numbers."""
    unit = 10**digits
    size = f"((2 * abs(cast({num} AS HUGEINT)) * {unit} + cast(({den}) AS HUGEINT)) // (2 * nullif(cast(({den}) AS HUGEINT), 0)))"
    return f"(CASE WHEN ({num}) < 0 THEN -1.0 ELSE 1.0 END * cast({size} AS DOUBLE) / {unit}.0)"


def _cents(amount: str) -> str:
    return f"sum(cast(round({amount} * 100) AS BIGINT))"


def _money(factor: str) -> str:
    price = "cast(unit_price AS DECIMAL(18,6)) * cast(quantity AS DECIMAL(10,0))"
    return f"cast(round({price}{factor}, 2) AS DOUBLE)"


_PCT = "cast(0.01 AS DECIMAL(3,2))"

TYPED = """
SELECT order_id, customer_id, product_id, store_id, category, try_cast(quantity AS INTEGER) quantity,
  try_cast(unit_price AS DOUBLE) unit_price, try_cast(discount_pct AS INTEGER) discount_pct,
  cast(try_strptime(order_date, '%Y-%m-%d') AS DATE) order_date, cast(try_strptime(ship_date, '%Y-%m-%d') AS DATE) ship_date,
  status, country, channel, payment
FROM feed"""

VALID = """
SELECT * FROM typed
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL AND unit_price IS NOT NULL
  AND product_id IS NOT NULL AND unit_price > 0 AND quantity > 0 AND discount_pct BETWEEN 0 AND 100"""

NORM = """
SELECT * REPLACE (
  CASE WHEN lower(trim(status)) IN ('completed', 'returned', 'pending', 'cancelled', 'processing')
    THEN lower(trim(status)) ELSE 'unknown' END AS status,
  lower(trim(channel)) AS channel, lower(trim(payment)) AS payment, upper(trim(country)) AS country)
FROM valid"""

DEDUP = """
SELECT * FROM norm
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC, ship_date DESC NULLS LAST, customer_id,
  product_id, unit_price DESC, quantity DESC, store_id NULLS LAST, category NULLS LAST, discount_pct NULLS LAST,
  status NULLS LAST, country NULLS LAST, channel NULLS LAST, payment NULLS LAST) = 1"""

STAGED = f"""
SELECT *, {_money(f" * cast(discount_pct AS DECIMAL(3,0)) * {_PCT}")} discount_amount, {_money("")} gross_amount,
  {_money(f" * cast(100 - discount_pct AS DECIMAL(3,0)) * {_PCT}")} net_amount,
  cast(year(order_date) AS INTEGER) AS year, cast(month(order_date) AS INTEGER) AS month,
  cast(quarter(order_date) AS INTEGER) AS quarter, cast(dayofweek(order_date) + 1 AS INTEGER) day_of_week,
  dayofweek(order_date) IN (0, 6) is_weekend, cast(datediff('day', order_date, ship_date) AS INTEGER) days_to_ship
FROM dedup"""

STG = """
SELECT order_id, customer_id, product_id, store_id, category product_category, lower(trim(channel)) sales_channel,
  lower(trim(payment)) payment_method, lower(trim(status)) order_status, upper(trim(country)) country_code,
  quantity, unit_price, coalesce(discount_pct, 0) discount_pct, gross_amount, discount_amount, net_amount,
  order_date, ship_date, days_to_ship, year order_year, month order_month, quarter order_quarter, day_of_week, is_weekend
FROM staged
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL AND unit_price > 0 AND quantity > 0"""

COUNTRY_MODE = """
SELECT customer_id, min({{'less': -n, 'value': country_code}}).value country_code
FROM (FROM {stg} SELECT customer_id, country_code, count(country_code) n GROUP BY ALL HAVING n > 0) GROUP BY customer_id"""

CATEGORY_MODE = """
SELECT product_id, min({'less': -n, 'value': product_category}).value category
FROM (FROM stg SELECT product_id, product_category, count(product_category) n GROUP BY ALL HAVING n > 0) GROUP BY product_id"""


def _customers(stg: str, as_of: str) -> str:
    return f"""
SELECT md5(customer_id) customer_key, customer_id, country_code, first_order_date, last_order_date, total_orders,
  cast(spend AS DOUBLE) / 100.0 total_spend, {_ratio('spend', '100 * n', 2)} avg_order_value, distinct_categories,
  cast(datediff('day', last_order_date, {as_of}) AS INTEGER) days_since_last_order,
  CASE WHEN spend >= 1000000 AND total_orders >= 20 THEN 'platinum' WHEN spend >= 500000 AND total_orders >= 10 THEN 'gold'
    WHEN spend >= 100000 AND total_orders >= 3 THEN 'silver' ELSE 'bronze' END customer_segment,
  CASE WHEN datediff('day', last_order_date, {as_of}) > 180 THEN 'high'
    WHEN datediff('day', last_order_date, {as_of}) > 90 THEN 'medium' ELSE 'low' END churn_risk
FROM (FROM {stg} SELECT customer_id, min(order_date) first_order_date, max(order_date) last_order_date,
    count(DISTINCT order_id) total_orders, {_cents('net_amount')} spend, count(net_amount) n,
    count(DISTINCT product_category) distinct_categories
  WHERE order_status <> 'cancelled' GROUP BY customer_id) LEFT JOIN ({COUNTRY_MODE.format(stg=stg)}) USING (customer_id)"""


PROD = f"""
WITH figures AS (
  FROM stg SELECT product_id, count(DISTINCT order_id) total_orders, cast(sum(quantity) AS BIGINT) total_units_sold,
    {_cents('net_amount')} revenue, sum(cast(round(unit_price * 1000000) AS BIGINT)) price, count(unit_price) price_n,
    sum(discount_pct) disc, count(discount_pct) disc_n, count(*) FILTER (WHERE order_status = 'returned') return_count,
    count(DISTINCT customer_id) unique_buyers GROUP BY product_id),
ahead AS (
  SELECT a.product_id, (SELECT count(*) FROM figures b WHERE b.revenue IS NULL AND a.revenue IS NOT NULL OR b.revenue > a.revenue) n FROM figures a)
SELECT md5(f.product_id) product_key, f.product_id, m.category, total_orders, total_units_sold,
  cast(revenue AS DOUBLE) / 100.0 total_revenue, {_ratio('price', 'price_n * 1000000', 2)} avg_selling_price,
  {_ratio('disc', 'disc_n', 1)} avg_discount_pct, return_count, unique_buyers,
  {_ratio('return_count * 100', 'total_orders', 2)} return_rate_pct,
  CASE WHEN n < 100 THEN 'top_100' WHEN n < 500 THEN 'top_500' ELSE 'standard' END revenue_tier
FROM figures f JOIN ahead ON f.product_id IS NOT DISTINCT FROM ahead.product_id
LEFT JOIN ({CATEGORY_MODE}) m ON f.product_id IS NOT DISTINCT FROM m.product_id"""

CAL = f"""
SELECT cast(strftime(d, '%Y%m%d') AS INTEGER) date_key, d full_date, cast(year(d) AS INTEGER) AS year,
  cast(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) quarter_label, cast(month(d) AS INTEGER) AS month,
  strftime(d, '%B') month_name, strftime(d, '%b') month_short, cast(weekofyear(d) AS INTEGER) week_of_year,
  cast(isoyear(d) AS INTEGER) year_of_week, cast(dayofyear(d) AS INTEGER) day_of_year,
  cast(day(d) AS INTEGER) day_of_month, cast(dayofweek(d) AS INTEGER) day_of_week, strftime(d, '%A') day_name,
  strftime(d, '%a') day_short, dayofweek(d) IN (0, 6) is_weekend, d <= {AS_OF} is_past,
  year(d) = year({AS_OF}) AND month(d) = month({AS_OF}) is_current_month, year(d) = year({AS_OF}) is_current_year
FROM (SELECT cast(unnest(generate_series(date_trunc('year', lo), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS DATE) d
  FROM (SELECT cast(min(order_date) AS TIMESTAMP) lo, max(order_date) hi FROM stg))"""

FCT = """
SELECT md5(order_id) sale_key, order_id, o.customer_id, product_id, store_id,
  cast(strftime(order_date, '%Y%m%d') AS INTEGER) date_key, sales_channel, payment_method, order_status, o.country_code,
  coalesce(c.customer_segment, 'unknown') customer_segment, quantity, unit_price, discount_pct,
  coalesce(discount_amount, 0) discount_amount, gross_amount, coalesce(net_amount, gross_amount) net_amount, days_to_ship,
  order_date, ship_date, order_year, order_month, order_quarter, day_of_week, is_weekend,
  coalesce(order_status = 'returned', false) is_return, coalesce(discount_pct > 0, false) has_discount,
  coalesce(days_to_ship <= 2, false) is_fast_shipped
FROM stg o LEFT JOIN cust c ON o.customer_id = c.customer_id"""

CHAIN = [
    ("feed", feed_sql_for_oracle()),
    ("typed", TYPED),
    ("valid", VALID),
    ("norm", NORM),
    ("dedup", DEDUP),
    ("staged", STAGED),
    ("stg", STG),
    ("cust", _customers("stg", AS_OF)),
    ("prod", PROD),
    ("cal", CAL),
    ("fct", FCT),
]


def _on(last: str, select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``select`` behind the chain of named steps up to ``last``."""
    names = [name for name, _ in CHAIN]
    steps = CHAIN[: names.index(last) + 1] + (extra or [])
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in steps) + "\n" + select


# --- contracts -------------------------------------------------------------------------------------


def _check(name: str, severity: str, bad: str, ok: str | None = None, percent: str | None = None, source: str = "staged") -> str:
    verdict = ok or "bad = 0"
    pct = percent or "cast(bad AS DOUBLE) / total * 100.0"
    return (
        f"SELECT '{name}' AS name, {verdict} AS success, '{severity}' AS severity, cast(bad AS BIGINT) AS invalid_count, "
        f"cast({pct} AS DOUBLE) AS unexpected_percent FROM (SELECT {bad} AS bad, count(*) AS total FROM {source})"
    )


def _where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _gate() -> str:
    lines = [_check(f"{c}: no nulls", "critical", _where(f"{c} IS NULL")) for c in
             ("order_id", "customer_id", "product_id", "order_date", "unit_price")]
    outside = "total < 800000 OR total > 1200000"
    lines += [
        "SELECT 'order_id: globally unique', bad = 0, 'critical', bad, cast(bad AS DOUBLE) / total * 100.0 FROM "
        "(SELECT count(*) FILTER (WHERE n > 1) bad, sum(n) total FROM (SELECT count(*) n FROM staged GROUP BY order_id))",
        f"SELECT 'row count: within expected range', NOT ({outside}), 'critical', CASE WHEN {outside} THEN total ELSE 0 END, "
        f"CASE WHEN {outside} THEN 100.0 ELSE 0.0 END FROM (SELECT count(*) total FROM staged)",
        _check("unit_price: positive and bounded", "critical", _where("unit_price < 0.01 OR unit_price > 10000 OR unit_price IS NULL")),
        _check("quantity: valid range 1–100", "critical", _where("quantity < 1 OR quantity > 100 OR quantity IS NULL")),
        _check("net_amount: always positive", "critical", _where("net_amount < 0.01 OR net_amount IS NULL")),
        _check("status: accepted values only", "critical",
               _where("status NOT IN ('completed','returned','pending','cancelled','processing','unknown') OR status IS NULL")),
        "SELECT 'schema: all required columns present', true, 'critical', 0, 0.0",
        "SELECT 'customer_id: cardinality in expected range', r BETWEEN 0.01 AND 0.20, 'warning', "
        "CASE WHEN r BETWEEN 0.01 AND 0.20 THEN 0 ELSE d END, CASE WHEN r BETWEEN 0.01 AND 0.20 THEN 0.0 ELSE 100.0 END "
        "FROM (SELECT count(*) d, cast(count(*) AS DOUBLE) / sum(n) r FROM (SELECT count(*) n FROM staged GROUP BY customer_id))",
        _check("category: at least 95% populated", "warning", _where("category IS NULL OR trim(category) = ''"),
               ok="1 - cast(bad AS DOUBLE) / total >= 0.95"),
        _check("customer_id: format C######", "warning",
               _where("NOT regexp_full_match(customer_id, 'C[0-9]{6}') OR customer_id IS NULL")),
        _check("product_id: format P#####", "warning",
               _where("NOT regexp_full_match(product_id, 'P[0-9]{5}') OR product_id IS NULL")),
    ]
    return "\nUNION ALL ".join(lines)


def _declared() -> str:
    statuses = "('completed','returned','pending','cancelled','processing','unknown')"
    tests: list[tuple[str, str, str, str, str, str]] = []

    def rows(label: str, table: str, test: str, column: str, condition: str) -> None:
        tests.append((label, column, test, "error", table, f"count(*) FILTER (WHERE {condition})"))

    def filled(label: str, table: str, *columns: str) -> None:
        for c in columns:
            rows(label, table, "not_null", c, f"{c} IS NULL")

    def unique(label: str, table: str, *columns: str) -> None:
        for c in columns:
            source = f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            tests.append((label, c, "unique", "error", source, "count(*)"))

    def parent(label: str, table: str, column: str, other: str, severity: str = "error") -> None:
        source = f"{table} ch LEFT JOIN {other} pa ON ch.{column} = pa.{column}"
        failing = f"count(*) FILTER (WHERE ch.{column} IS NOT NULL AND pa.{column} IS NULL)"
        tests.append((label, column, "relationships", severity, source, failing))

    filled("raw_orders", "staged", "order_id", "customer_id", "product_id", "unit_price", "quantity", "order_date")
    unique("raw_orders", "staged", "order_id")
    parent("raw_orders", "staged", "customer_id", "cust", "warn")
    rows("raw_orders", "staged", "expression_is_true", "unit_price", "NOT (unit_price > 0)")
    rows("raw_orders", "staged", "expression_is_true", "quantity", "NOT (quantity > 0)")
    rows("raw_orders", "staged", "accepted_values", "status", f"status NOT IN {statuses}")
    filled("fct_sales", "fct", "sale_key", "order_id", "customer_id", "product_id", "date_key", "net_amount", "quantity")
    unique("fct_sales", "fct", "sale_key", "order_id")
    parent("fct_sales", "fct", "customer_id", "cust")
    parent("fct_sales", "fct", "product_id", "prod")
    parent("fct_sales", "fct", "date_key", "cal")
    rows("fct_sales", "fct", "accepted_values", "order_status", f"order_status NOT IN {statuses}")
    rows("fct_sales", "fct", "expression_is_true", "net_amount", "NOT (net_amount >= 0)")
    rows("fct_sales", "fct", "expression_is_true", "quantity", "NOT (quantity > 0)")
    rows("fct_sales", "fct", "expression_is_true", "gross_amount", "discount_pct > 0 AND NOT (gross_amount >= net_amount)")
    filled("dim_customers", "cust", "customer_key", "customer_id")
    unique("dim_customers", "cust", "customer_key", "customer_id")
    rows("dim_customers", "cust", "accepted_values", "customer_segment", "customer_segment NOT IN ('platinum','gold','silver','bronze')")
    rows("dim_customers", "cust", "accepted_values", "churn_risk", "churn_risk NOT IN ('high','medium','low')")
    rows("dim_customers", "cust", "expression_is_true", "total_spend", "NOT (total_spend >= 0)")
    rows("dim_customers", "cust", "expression_is_true", "total_orders", "NOT (total_orders > 0)")
    filled("dim_products", "prod", "product_key", "product_id")
    unique("dim_products", "prod", "product_key", "product_id")
    rows("dim_products", "prod", "accepted_values", "revenue_tier", "revenue_tier NOT IN ('top_100','top_500','standard')")
    rows("dim_products", "prod", "expression_is_true", "return_rate_pct", "NOT (return_rate_pct BETWEEN 0 AND 100)")
    filled("dim_date", "cal", "date_key", "full_date")
    unique("dim_date", "cal", "date_key", "full_date")
    rows("dim_date", "cal", "accepted_values", "quarter", "quarter NOT IN (1, 2, 3, 4)")
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{column}' AS column_name, '{test}' AS test, "
        f"CASE WHEN n = 0 THEN 'pass' ELSE '{severity}' END AS status, n AS failures FROM (SELECT {counted} n FROM {source})"
        for label, column, test, severity, source, counted in tests
    )


# --- history ---------------------------------------------------------------------------------------

RUNS = ["1998-12-31", "2000-06-30", "2001-10-01"]
TRACKED = ("customer_key, customer_id, country_code, first_order_date, last_order_date, total_orders, total_spend, "
           "avg_order_value, customer_segment, churn_risk")


def _history(keep: str) -> str:
    """Versions after each run: closed history, then the open rows against the new input."""
    extra: list[tuple[str, str]] = []
    for i, day in enumerate(RUNS):
        at = f"TIMESTAMP '{day} 00:00:00'"
        extra.append((f"stg{i}", f"SELECT * FROM stg WHERE order_date <= DATE '{day}'"))
        extra.append((f"in{i}", f"SELECT {TRACKED} FROM ({_customers(f'stg{i}', f'DATE {chr(39)}{day}{chr(39)}')}) WHERE {keep}"))
        fresh = (f"SELECT n.*, md5(n.customer_id || '|{day} 00:00:00') dbt_scd_id, {at} version_updated_at, {at} dbt_valid_from, "
                 f"cast(NULL AS TIMESTAMP) dbt_valid_to FROM in{i} n")
        if i == 0:
            extra.append(("h0", fresh))
            continue
        prev = f"h{i - 1}"
        same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in ("customer_segment", "churn_risk", "total_orders", "total_spend"))
        unchanged = f"SELECT 1 FROM in{i} n WHERE n.customer_id = o.customer_id AND {same}"
        open_same = f"SELECT 1 FROM {prev} o WHERE o.customer_id = n.customer_id AND o.dbt_valid_to IS NULL AND {same}"
        extra.append((f"h{i}", f"""
SELECT o.* REPLACE (CASE WHEN o.dbt_valid_to IS NULL AND NOT EXISTS ({unchanged}) THEN {at} ELSE o.dbt_valid_to END AS dbt_valid_to)
FROM {prev} o
UNION ALL {fresh} WHERE NOT EXISTS ({open_same})"""))
    return _on("stg", f"SELECT * FROM h{len(RUNS) - 1}", extra)


def _noisy() -> str:
    fields = ("order_id, customer_id, product_id, store_id, category, quantity, unit_price, discount_pct, order_date, "
              "ship_date, status, country, channel, payment")

    def draw(purpose: str) -> str:
        return f"cast('0x' || substr(md5(concat_ws('|', '42|{purpose}', ident)), 1, 8) AS BIGINT) / 4294967296.0"

    def nulled(position: int, column: str) -> str:
        return f"CASE WHEN r_null < 0.03 AND cast(floor(r_victim * 4) AS INTEGER) = {position} THEN NULL ELSE {column} END AS {column}"

    drawn = ", ".join(f"{draw(p)} AS r_{p}" for p in ("null", "victim", "date", "sign", "copy"))
    return _on("feed", f"""
SELECT order_id, customer_id, product_id, store_id, {nulled(0, 'category')}, quantity,
  CASE WHEN r_sign < 0.002 THEN '-' || ltrim(unit_price, '-') ELSE unit_price END AS unit_price, {nulled(3, 'discount_pct')},
  CASE WHEN r_date < 0.005 THEN '9999-99-99' ELSE order_date END AS order_date, {nulled(2, 'ship_date')},
  status, {nulled(1, 'country')}, channel, payment
FROM (SELECT *, {drawn}, unnest(CASE WHEN {draw('copy')} < 0.01 THEN [1, 2] ELSE [1] END) AS copy_no
  FROM (SELECT *, concat_ws('|', {fields}) AS ident FROM feed))""")


def statements() -> dict[str, str]:
    day = r"NOT regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}') OR try_cast({0} AS DATE) IS NULL"
    rejected = {
        **{name: f"{name} IS NULL" for name in ("order_id", "customer_id", "product_id")},
        "quantity": "quantity IS NOT NULL AND try_cast(quantity AS INTEGER) IS NULL",
        "unit_price": "unit_price IS NOT NULL AND try_cast(unit_price AS DOUBLE) IS NULL",
        "discount_pct": "discount_pct IS NOT NULL AND try_cast(discount_pct AS INTEGER) IS NULL",
        "order_date": f"order_date IS NOT NULL AND ({day.format('order_date')})",
        "ship_date": f"ship_date IS NOT NULL AND ({day.format('ship_date')})",
    }
    any_bad = " OR ".join(f"({c})" for c in rejected.values())
    reasons = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rejected.items())
    gate = _gate()
    staged_order = "SELECT 1 FROM staged s WHERE s.order_id = f.order_id"
    totals = f"{_cents('net_amount')} cents, count(net_amount) n"
    loaded = (
        "order_id, customer_id, product_id, store_id, category, quantity, unit_price, discount_pct, order_date, ship_date, "
        "status, country, channel, payment, gross_amount, net_amount, discount_amount, year, month, quarter, day_of_week, "
        "is_weekend, days_to_ship"
    )

    def trend(period: str) -> str:
        return _on("fct", f"""
SELECT {period} AS month, cast({_cents('f.net_amount')} AS DOUBLE) / 100.0 AS net_revenue, count(DISTINCT f.order_id) AS total_orders
FROM fct f JOIN cal d ON f.date_key = d.date_key GROUP BY 1 ORDER BY 1""")

    return {
        "raw_feed": _on("feed", "SELECT * FROM feed"),
        "csv_feed_scan": _on("feed", "SELECT * FROM feed"),
        "typed_orders": _on("typed", "SELECT * FROM typed"),
        "valid_orders": _on("valid", "SELECT * FROM valid"),
        "normalised_orders": _on("norm", "SELECT * FROM norm"),
        "deduped_orders": _on("dedup", "SELECT * FROM dedup"),
        "staged_orders": _on("staged", "SELECT * FROM staged"),
        "staged_roundtrip": _on("staged", "SELECT * FROM staged"),
        "etl_funnel": _on("dedup", f"""
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS rows_dropped, {_ratio('(raw_rows - clean_rows) * 100', 'raw_rows', 1)} AS drop_rate_pct
FROM (SELECT (SELECT count(*) FROM feed) raw_rows, (SELECT count(*) FROM dedup) clean_rows)"""),
        "noisy_feed": _noisy(),
        "copy_into_good": _on("feed", f"""
SELECT order_id, customer_id, product_id, store_id, category, cast(quantity AS INTEGER) quantity,
  cast(unit_price AS DOUBLE) unit_price, cast(discount_pct AS INTEGER) discount_pct, cast(order_date AS DATE) order_date,
  cast(ship_date AS DATE) ship_date, status, country, channel, payment
FROM feed WHERE NOT ({any_bad})"""),
        "copy_into_errors": _on("feed", f"SELECT *, concat_ws(',', {reasons}) AS load_reason FROM feed WHERE {any_bad}"),
        "copy_into_counts": _on("feed", f"""
SELECT CASE WHEN {any_bad} THEN 'rows_errors' ELSE 'rows_loaded' END AS outcome, count(*) AS row_count FROM feed GROUP BY 1"""),
        "copy_into_strict": _on("staged", f"SELECT {loaded} FROM staged"),
        "load_files_good": _on("staged", f"SELECT {loaded} FROM staged WHERE cast(substr(order_id, 2, 8) AS INTEGER) % 50 NOT BETWEEN 1 AND 4"),
        "load_files_errors": _on("staged", """
SELECT order_id, CASE WHEN k <> 4 THEN customer_id END customer_id,
  CASE k WHEN 1 THEN 'x' WHEN 2 THEN '2.5' ELSE cast(quantity AS VARCHAR) END quantity,
  CASE WHEN k = 3 THEN '2024-02-30' ELSE cast(order_date AS VARCHAR) END order_date,
  cast(year AS VARCHAR) AS year, cast(month AS VARCHAR) AS month,
  CASE k WHEN 3 THEN 'order_date' WHEN 4 THEN 'customer_id' ELSE 'quantity' END load_reason
FROM (SELECT *, cast(substr(order_id, 2, 8) AS INTEGER) % 50 k FROM staged) WHERE k BETWEEN 1 AND 4"""),
        "snapshot_replace_verify": _on("staged", "SELECT count(*) AS total_orders, count(DISTINCT order_id) AS unique_orders, true AS has_load_time FROM staged"),
        "dim_date_fixed": _on("stg", f"""
SELECT d.*, count(o.order_id) AS orders
FROM ({CAL.replace("FROM stg)", "FROM (VALUES (DATE '1998-01-01'), (DATE '2000-12-31')) fixed (order_date))")}) d
  LEFT JOIN stg o ON o.order_date = d.full_date GROUP BY ALL"""),
        "warehouse_table": _on("staged", "SELECT * FROM staged"),
        "staging_view": _on("stg", "SELECT * FROM stg"),
        "load_check": _on("staged", "SELECT count(*) AS row_count, true AS has_load_time FROM staged"),
        "load_verification": _on("staged", f"""
SELECT total_orders, unique_customers, unique_products, earliest_order, latest_order,
  {_ratio('cents', '100000000', 2)} AS total_revenue_m, {_ratio('cents', '100 * n', 2)} AS avg_order_value
FROM (SELECT count(*) total_orders, count(DISTINCT customer_id) unique_customers, count(DISTINCT product_id) unique_products,
  min(order_date) earliest_order, max(order_date) latest_order, {totals} FROM staged)"""),
        "load_profile": _on("staged", f"""
SELECT total_rows, unique_customers, earliest_order, latest_order, {_ratio('cents', '100000000', 2)} AS revenue_millions
FROM (SELECT count(*) total_rows, count(DISTINCT customer_id) unique_customers, min(order_date) earliest_order,
  max(order_date) latest_order, {totals} FROM staged)"""),
        "load_stamps": _on("staged", """
SELECT year, month, count(*) AS orders, count(*) AS stamped, true AS one_moment, true AS in_the_past FROM staged GROUP BY ALL"""),
        "legal_names": _on("feed", """
SELECT DISTINCT name, regexp_full_match(name, '[A-Za-z_][A-Za-z0-9_$]*([.][A-Za-z_][A-Za-z0-9_$]*)*') AS legal
FROM (SELECT unnest([category, status, country, store_id, channel, concat_ws('.', country, channel)]) name FROM feed) WHERE name IS NOT NULL"""),
        "quality_gate_of_nothing": _on("staged", f"""
SELECT name, name LIKE 'schema:%' AS success, severity, 0 AS invalid_count,
  CASE WHEN name LIKE 'row count:%' OR name LIKE '%: cardinality in%' THEN 100.0 ELSE 0.0 END::DOUBLE AS unexpected_percent
FROM ({gate})"""),
        "stg_orders": _on("stg", "SELECT * FROM stg"),
        "dim_date": _on("cal", "SELECT * FROM cal"),
        "dim_customers": _on("cust", "SELECT * FROM cust"),
        "dim_products": _on("prod", "SELECT * FROM prod"),
        "fct_sales": _on("fct", "SELECT * FROM fct"),
        "customer_country_mode": _on("stg", COUNTRY_MODE.format(stg="stg")),
        "product_category_mode": _on("stg", CATEGORY_MODE),
        "customer_rfm": _on("cust", "SELECT customer_id, total_orders, total_spend, customer_segment FROM cust"),
        "customer_churn": _on("cust", "SELECT customer_id, days_since_last_order, churn_risk FROM cust"),
        "product_revenue_tier": _on("prod", "SELECT product_id, total_revenue, revenue_tier FROM prod"),
        "product_return_rate": _on("prod", "SELECT product_id, return_count, total_orders, return_rate_pct FROM prod"),
        "revenue_trend_daily": trend("d.full_date"),
        "revenue_trend_monthly": trend("cast(date_trunc('month', d.full_date) AS DATE)"),
        "revenue_by_category": _on("fct", f"""
SELECT p.category AS product_category, cast({_cents('f.net_amount')} AS DOUBLE) / 100.0 AS net_revenue
FROM fct f JOIN prod p ON f.product_id = p.product_id GROUP BY p.category ORDER BY net_revenue DESC"""),
        "segment_mix": _on("cust", "SELECT customer_segment, count(*) AS customers FROM cust GROUP BY 1 ORDER BY 2 DESC"),
        "top_countries": _on("fct", f"""
SELECT c.country_code, cast({_cents('f.net_amount')} AS DOUBLE) / 100.0 AS revenue
FROM fct f JOIN cust c ON f.customer_id = c.customer_id GROUP BY c.country_code
ORDER BY revenue DESC NULLS FIRST, c.country_code NULLS FIRST LIMIT 10"""),
        "channel_performance": _on("fct", f"""
SELECT channel, orders, cast(cents AS DOUBLE) / 100.0 AS revenue, {_ratio('cents', '100 * n', 2)} AS average_order_value,
  {_ratio('ship_days', 'shipped', 1)} AS avg_ship_days
FROM (SELECT sales_channel channel, count(DISTINCT order_id) orders, {totals}, sum(days_to_ship) ship_days, count(days_to_ship) shipped
  FROM fct GROUP BY 1) ORDER BY revenue DESC"""),
        "churn_summary": _on("cust", f"""
SELECT label AS churn_risk, count(*) AS customers, cast({_cents('total_spend')} AS DOUBLE) / 100.0 AS customer_revenue
FROM cust JOIN (VALUES (0, 90, 'Low Risk'), (91, 180, 'Medium Risk'), (181, 1000000, 'High Risk')) limits (least, most, label)
  ON coalesce(greatest(datediff('day', last_order_date, {AS_OF}), 0), 1000000) BETWEEN least AND most
GROUP BY label"""),
        "quality_gate_report": _on("staged", gate),
        "quality_gate_verdict": _on("staged", f"""
SELECT count(*) AS checks, count(*) FILTER (WHERE success) AS passed,
  coalesce(string_agg(name, ', ' ORDER BY name) FILTER (WHERE NOT success AND severity = 'critical'), '') AS critical_failures,
  coalesce(string_agg(name, ', ' ORDER BY name) FILTER (WHERE NOT success AND severity = 'warning'), '') AS warnings,
  count(*) FILTER (WHERE NOT success AND severity = 'critical') = 0 AS cleared
FROM ({gate})"""),
        "duplicate_order_ids": _on("feed", "SELECT order_id, count(*) AS copies FROM feed GROUP BY 1 HAVING count(*) > 1"),
        "not_null_test": _on("feed", "SELECT * FROM feed WHERE order_id IS NULL"),
        "unique_test": _on("feed", "SELECT order_id, count(*) AS copies FROM feed WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
        "accepted_values_test": _on("feed", "SELECT * FROM feed WHERE status NOT IN ('completed','returned','pending','cancelled','processing')"),
        "expression_test": _on("stg", "SELECT * FROM stg WHERE discount_pct > 0 AND NOT (gross_amount >= 1000)"),
        "relationships_test": _on("staged", f"SELECT * FROM feed f WHERE order_id IS NOT NULL AND NOT EXISTS ({staged_order})"),
        "orphan_keys_test": _on("staged", f"""
SELECT order_id, count(*) AS orphan_rows FROM feed f WHERE order_id IS NOT NULL AND NOT EXISTS ({staged_order}) GROUP BY 1"""),
        "freshness": _on("staged", """
SELECT newest_load, age // 3600 AS age_hours,
  CASE WHEN age > 48 * 3600 THEN 'error' WHEN age > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT newest_load, datediff('second', newest_load, TIMESTAMP '2001-10-01 12:00:00') age
  FROM (SELECT cast(max(order_date) AS TIMESTAMP) newest_load FROM staged))"""),
        "declared_tests_report": _on("fct", _declared()),
        "customers_scd2": _history("true"),
        "active_customers_scd2": _history("churn_risk != 'high'"),
    }
