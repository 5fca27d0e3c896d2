"""The four source tables derived from the benchmark tables of this repository.

The statements run unchanged on Spark and on other SQL engines, so the checking
SQL can start from the same tables.  Listings of activity are drawn from as many ids
as there are listings and a few more: those few are unknown listings.  Two users
make a third of all bookings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.conform import conform
from ..schemas import TABLES

STATEMENTS = {
    "apartments": """
select p_partkey as id, p_name as title, p_brand as source, p_retailprice as price,
  'USD' as currency,
  TIMESTAMP '1995-01-01 00:00:00' + (p_partkey % 2400) * INTERVAL '1' DAY as listing_created_on,
  (p_partkey % 10 <> 0) as is_active
from {part}""",
    "apartment_attributes": """
select p_partkey as id, p_partkey as apartment_id, p_type as category, p_name as amenities,
  p_retailprice as price,
  case when p_partkey % 17 = 0 then null when p_partkey % 13 = 0 then 0 else p_size * 20 end
    as square_feet,
  n_name as cityname, r_name as state
from {part} join {nation} on n_nationkey = p_partkey % 25
  join {region} on n_regionkey = r_regionkey""",
    "user_viewings": """
select event_id as id, user_id,
  (event_id * 7919) % (select count(*) + 7 from {part}) as apartment_id,
  ts - 10587 * INTERVAL '1' DAY
    + (((event_id + user_id * 13) % 80) * 30) * INTERVAL '1' DAY as viewed_at,
  event_type = 'click' as is_wishlisted, event_type as call_to_action
from {events}""",
    "bookings": """
select o_orderkey as id, o_orderkey as booking_id,
  case when o_orderkey % 3 = 0 then o_custkey % 2 else o_custkey end as user_id,
  ((o_orderkey - o_orderkey % 9) * 7919) % (select count(*) + 7 from {part}) as apartment_id,
  o_orderdate as booking_date,
  o_orderdate + (o_orderkey % 45) * INTERVAL '1' DAY as checkin_date,
  o_orderdate + (o_orderkey % 45 + 1 + o_orderkey % 14) * INTERVAL '1' DAY as checkout_date,
  o_totalprice as total_price, 'USD' as currency,
  case o_orderstatus when 'F' then 'confirmed' when 'O' then 'pending' else 'canceled' end
    as booking_status,
  case when o_orderstatus = 'F' then 'paid' else 'unpaid' end as payment_status,
  1 + o_orderkey % 6 as num_guests
from {orders}""",
}

# Column types of the benchmark tables the statements read: stating them spares
# a footer scan per read.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

_INPUTS = {
    "apartments": ["part"],
    "apartment_attributes": ["part", "nation", "region"],
    "user_viewings": ["events", "part"],
    "bookings": ["orders", "part"],
}


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read
    if name in BASE_SCHEMAS:
        reader = reader.schema(BASE_SCHEMAS[name])
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def source_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One source table with its declared types (attributes keep their price)."""
    inputs = {name: base_table(spark, folder, name) for name in _INPUTS[table]}
    return conform(spark.sql(STATEMENTS[table], **inputs), TABLES[table], keep_extra=True)


# Expressions that break declared constraints here and there, in the same SQL.
_DAMAGE = {
    ("apartments", "title"): "case when id % 11 = 0 then repeat(title, 30) when id % 13 = 0 then null else title end",
    ("apartments", "price"): "case when id % 17 = 0 then null else price end",
    ("user_viewings", "user_id"): "case when id % 23 = 0 then null else user_id end",
    ("user_viewings", "call_to_action"): "case when id % 29 = 0 then repeat(call_to_action, 40) else call_to_action end",
    ("bookings", "booking_id"): "case when id % 19 = 0 then 5 else booking_id end",
    ("bookings", "booking_status"): "case when id % 31 = 0 then repeat(booking_status, 9) else booking_status end",
}


def damaged_statement(table: str, source: str) -> str:
    """``source`` with broken constraints and every hundredth row twice."""
    names = TABLES[table].schema.names
    columns = ", ".join(f"{_DAMAGE.get((table, c), c)} as {c}" for c in names)
    return f"select {columns} from {source} union all select {', '.join(names)} from {source} where id % 100 = 1"


def damaged_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.sql(damaged_statement(table, "{source}"), source=source_table(spark, folder, table))
