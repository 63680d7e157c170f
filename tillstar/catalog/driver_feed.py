"""The raw order feed seen through the driver tables: one text order per line item.

``(l_orderkey, l_linenumber)`` repeats, which supplies duplicate order ids; an integer hash of the row
plants missing keys, unparsable numbers, negative prices, impossible dates and unknown statuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The feed definition. ``{div}`` is integer division in the engine that runs it.
FEED_SQL = """
WITH b AS (
  SELECT l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk, o_custkey ck, cast(l_quantity AS int) q,
    cast(round(l_extendedprice * 100) AS bigint) {div} (cast(l_quantity AS bigint) * 200) uc,
    cast(round(l_discount * 100) AS int) d, cast(o_orderdate AS date) od, cast(l_shipdate AS date) sd,
    l_returnflag rf, l_linestatus ls, s_nationkey nk,
    (l_orderkey * 7 + l_partkey * 13 + l_suppkey * 29 + l_linenumber * 3) % 1000 h
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey)
SELECT
  CASE WHEN h = 1 THEN NULL ELSE concat('O', lpad(cast(ok AS string), 8, '0'), '-', cast(ln AS string)) END order_id,
  concat('C', lpad(cast(ck AS string), 6, '0')) customer_id,
  concat('P', lpad(cast(pk AS string), 5, '0')) product_id,
  concat('S', lpad(cast(sk AS string), 3, '0')) store_id,
  CASE WHEN h BETWEEN 10 AND 17 THEN NULL ELSE CASE (pk + sk) % 7 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing'
    WHEN 2 THEN 'Food & Beverage' WHEN 3 THEN 'Sports' WHEN 4 THEN 'Home & Garden' WHEN 5 THEN 'Books'
    ELSE 'Toys' END END category,
  CASE WHEN h = 18 THEN 'abc' ELSE cast(q AS string) END quantity,
  concat(CASE WHEN h IN (20, 21) THEN '-' ELSE '' END, cast(uc {div} 100 AS string), '.',
    lpad(cast(uc % 100 AS string), 2, '0')) unit_price,
  CASE WHEN h BETWEEN 30 AND 37 THEN NULL ELSE cast(d AS string) END discount_pct,
  CASE WHEN h BETWEEN 40 AND 44 THEN '9999-99-99' ELSE cast(od AS string) END order_date,
  CASE WHEN h BETWEEN 50 AND 57 THEN NULL ELSE cast(sd AS string) END ship_date,
  CASE WHEN h = 60 THEN 'GARBAGE' WHEN rf = 'R' THEN 'Returned' WHEN rf = 'A' AND ls = 'F' THEN ' CANCELLED '
    WHEN rf = 'A' THEN 'pending' WHEN ls = 'O' THEN 'processing' ELSE 'completed' END status,
  CASE WHEN h BETWEEN 70 AND 77 THEN NULL ELSE CASE nk % 10 WHEN 0 THEN 'in' WHEN 1 THEN 'US' WHEN 2 THEN ' GB'
    WHEN 3 THEN 'DE' WHEN 4 THEN 'AU' WHEN 5 THEN 'CA' WHEN 6 THEN 'SG' WHEN 7 THEN 'AE' WHEN 8 THEN 'FR'
    ELSE 'JP' END END country,
  CASE ln % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'In-Store' ELSE 'mobile' END channel,
  CASE ok % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'UPI' WHEN 2 THEN 'net_banking' ELSE 'cod' END payment
FROM b
"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders", "supplier")}
    return spark.sql(FEED_SQL.replace("{div}", "DIV"), **tables)


def feed_sql_for_oracle() -> str:
    return FEED_SQL.format(div="//", lineitem="lineitem", orders="orders", supplier="supplier")
