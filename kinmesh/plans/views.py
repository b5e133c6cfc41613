"""A linkage task over the driver's tables: customers are masters, orders are fragments
with noise, suppliers are fragments that belong to nobody.

The expressions are read by Spark and by DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The words of the views over the driver's tables.
HEADS = "Brightleaf|Copper Kettle|Ironwood|Shree Ganesh|Northwind|Belle Rivière|Café Lumière|Anand|Quiet Harbor|Lotus Bay|Marigold"
TRADES = "Pharmacy|Bakery|Hardware|Textiles|Clinic|Motors|Grocers"
STREETS = "Maple Street|Cedar Road|Oakline Avenue|Harbour Boulevard|Gandhi Marg|Nehru Nagar|Rue Émile Zola"
FORMS = ("LLC|Inc|Corp", "Pvt Ltd|Private Limited|LLP", "SARL|SAS|SA")


def _pick(words: str, index: str) -> str:
    return f"split_part('{words}', '|', cast({index} as int))"


COUNTRY = "CASE c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END"
FORM = f"CASE c_nationkey % 3 WHEN 0 THEN {_pick(FORMS[0], 'c_custkey % 3 + 1')} WHEN 1 THEN {_pick(FORMS[1], 'c_custkey % 3 + 1')} ELSE {_pick(FORMS[2], 'c_custkey % 3 + 1')} END"
NAME = f"concat({_pick(HEADS, 'c_custkey % 11 + 1')}, ' ', {_pick(TRADES, 'cast(floor(c_custkey / 11.0) as int) % 7 + 1')}, ' ', {FORM})"
DIGITS = "CASE WHEN c_nationkey % 3 = 1 THEN cast(400000 + (c_custkey * 13) % 99999 as varchar(20)) ELSE cast(10000 + (c_custkey * 13) % 89999 as varchar(20)) END"
ADDRESS = f"concat(cast(10 + (c_custkey * 37) % 890 as varchar(20)), ' ', {_pick(STREETS, 'c_custkey % 7 + 1')}, ', ', n_name, ' ', {DIGITS})"

S1 = f"""SELECT concat('S1-', lpad(cast(c_custkey as varchar(20)), 8, '0')) AS entity_id, {NAME} AS business_name,
  {ADDRESS} AS business_address, {COUNTRY} AS country, c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

FRAGMENTS = """SELECT concat(CASE WHEN o_orderkey % 2 = 1 THEN 'S2-' ELSE 'S3-' END, lpad(cast(o_orderkey as varchar(20)), 8, '0')) AS entity_id,
  CASE o_orderkey % 7 WHEN 0 THEN upper(business_name)
    WHEN 3 THEN concat(substr(business_name, 1, 1), substr(business_name, 3, 1), substr(business_name, 2, 1), substr(business_name, 4))
    WHEN 5 THEN concat(business_name, ' Branch') ELSE business_name END AS business_name,
  CASE o_orderkey % 11 WHEN 1 THEN replace(replace(business_address, 'Street', 'St'), 'Road', 'Rd') WHEN 4 THEN 'NA' ELSE business_address END AS business_address,
  country, entity_id AS true_s1
FROM orders JOIN s1 ON o_custkey = c_custkey
UNION ALL
SELECT concat('S3-9', lpad(cast(s_suppkey as varchar(20)), 7, '0')), concat(s_name, ' Holdings'),
  concat(cast(1 + (s_suppkey * 7) % 90 as varchar(20)), ' Quay Lane, ', n_name), CASE s_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END, NULL
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

#: The two views as the head of a DuckDB query.
WITH = f"WITH s1 AS ({S1}), fr AS ({FRAGMENTS})"


def views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(masters, fragments with true_s1)."""
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("customer", "nation", "orders", "supplier")}
    s1 = spark.sql(S1.replace("FROM customer JOIN nation", "FROM {customer} AS customer JOIN {nation} AS nation"), customer=t["customer"], nation=t["nation"])
    fr = FRAGMENTS.replace("FROM orders JOIN s1", "FROM {orders} AS orders JOIN {s1} AS s1").replace("FROM supplier JOIN nation", "FROM {supplier} AS supplier JOIN {nation} AS nation")
    fr = spark.sql(fr, orders=t["orders"], s1=s1, supplier=t["supplier"], nation=t["nation"])
    return s1.drop("c_custkey"), fr
