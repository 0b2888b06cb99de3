"""Business tables derived from the given tables.

The text runs unchanged in Spark and in DuckDB; ``{name}`` stands for a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN = ["supplier", "part", "customer", "orders", "lineitem", "events"]

# The currency code that stands for the token itself.
TOKEN = "TOK"

VIEWS = {
    "rates": """
select 'USD' currency_code, cast(0.25 as decimal(11,6)) rate
union all select 'ILS', cast(0.9 as decimal(11,6))
""",
    "owners": """
select s_suppkey owner_id, s_name company_name,
 case s_suppkey % 3 when 0 then 'USD' when 1 then 'ILS' else 'TOK' end currency_code,
 cast((s_suppkey % 5) * 0.05 as decimal(7,6)) commission_factor,
 cast((s_suppkey % 4) * 0.25 as decimal(7,6)) token_share,
 cast(case when s_suppkey % 6 = 0 then null else s_acctbal * 100 end as decimal(18,2)) token_balance_base,
 concat('vendor-', cast(s_suppkey % 3 as string)) vendor_id,
 case when s_suppkey % 7 = 0 then null else concat('wallet-', cast(s_suppkey as string)) end wallet_address
from {supplier}
""",
    "vehicles": """
select p_partkey vehicle_id, p_partkey % (select count(*) from {supplier}) owner_id,
 case p_size % 4 when 0 then 'available' when 1 then 'onmission' when 2 then 'notavailable' else 'maintenance' end status,
 concat('QR', cast(p_partkey as string)) qr_code,
 case when p_partkey % 11 = 0 then '' else concat('dev-', cast(p_partkey as string)) end device_id,
 concat('vendor-', cast(p_partkey % 3 as string)) vendor,
 case when p_partkey % 9 = 0 then null else p_type end model,
 p_brand operator_name,
 cast(1 + p_size * 0.05 as decimal(18,2)) base_price,
 cast(0.10 + (p_partkey % 7) * 0.05 as decimal(18,2)) price_per_minute,
 cast(case when p_partkey % 5 = 0 then null else (p_partkey % 3) * 0.5 end as decimal(18,2)) reward_base,
 cast(case when p_partkey % 4 = 0 then null else 0.05 end as decimal(7,6)) reward_factor,
 cast(32.0 + (p_partkey * 37 % 1000) * 0.0005 as double) lat,
 cast(34.7 + (p_partkey * 53 % 1000) * 0.0005 as double) lon,
 cast(p_partkey % 100 as int) battery_percentage,
 cast(10.0 + (p_partkey % 3) as decimal(10,4)) battery_alpha, cast(-300.0 as decimal(10,4)) battery_beta
from {part}
""",
    "riders": """
select c_custkey rider_id, cast(case when c_custkey % 10 = 0 then null else c_acctbal end as decimal(18,2)) token_balance,
 concat('shopper-', cast(c_custkey as string)) payment_method_id,
 case when c_custkey % 8 = 0 then null else concat(c_mktsegment, '-', cast(c_nationkey as string)) end card
from {customer}
""",
    "rides": """
select ride_id, rider_id, vehicle_id, vehicle_id % (select count(*) from {supplier}) owner_id, start_time,
 case when k % 97 = 0 then null else start_time + interval '1' second * cast(qty * 53 as int) end end_time,
 cast(start_time as date) effective_date, parking_image_url, rating, price, paid_with_token, capture_transaction_id,
 token_awarded, cast(cast(qty as int) * 0.137 as decimal(18,3)) distance, k, line
from (select concat(cast(l_orderkey as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(l_linenumber as string)) ride_id,
  o_custkey rider_id, l_orderkey k, l_linenumber line, l_quantity qty,
  l_partkey vehicle_id,
  timestamp '2024-01-01 00:00:00' + interval '1' day * cast(l_orderkey % 60 as int)
   + interval '1' minute * cast((l_orderkey * 7 + l_linenumber * 31 + l_suppkey * 13) % 1380 as int) start_time,
  concat('img-', cast(l_orderkey as string), '-', cast(l_suppkey as string), '-', cast(l_linenumber as string)) parking_image_url,
  cast(l_linenumber % 6 as int) rating,
  cast(l_extendedprice as decimal(18,2)) price,
  case l_returnflag when 'R' then true when 'A' then false else null end paid_with_token,
  case when l_linestatus = 'F' then concat('cap-', cast(l_orderkey as string)) end capture_transaction_id,
  cast(1 + l_quantity as decimal(18,2)) token_awarded
 from {lineitem} join {orders} on l_orderkey = o_orderkey) r
""",
    "token_messages": """
select event_id, ts, user_id % (select count(*) from {supplier}) owner_id,
 case event_type when 'purchase' then 'OwnerToRider' when 'signup' then 'RiderToOwner' else 'NetworkOperatorToRider' end transaction_type,
 cast(value as decimal(18,2)) amount
from {events} where event_type in ('purchase', 'signup', 'click')
""",
    "iot_updates": """
select event_id, ts, concat('dev-', cast(user_id as string)) device_id,
 case when event_type = 'view' then cast(event_id % 101 as int) end battery_percentage,
 case when event_type = 'click' then cast(28 + value / 40 as double) end battery_voltage,
 case event_type when 'purchase' then 'unlocked' when 'signup' then 'locked' end state,
 case when event_type <> 'error' then cast(32.0 + (event_id * 37 % 1000) * 0.0005 as double) end lat,
 case when event_type <> 'error' then cast(34.7 + (event_id * 53 % 1000) * 0.0005 as double) end lon
from {events}
""",
}

# In Spark a bare timestamp literal has a time zone, in the files and in DuckDB it has none.
_SPARK_WORDS = {"timestamp '": "timestamp_ntz '"}


class Views:
    """The derived tables of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._read[name]

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        for word, own in _SPARK_WORDS.items():
            text = text.replace(word, own)
        used = {name: self.given(name) for name in GIVEN if "{" + name + "}" in text}
        return self._spark.sql(text, **{**used, **frames})

    def shared(self, name: str, *columns: str) -> DataFrame:
        """Columns of a derived table for several readers in one plan, which share the shuffles it is built by.

        Spark prunes columns and pushes filters for each reader alone, after which no shuffle of one equals that of
        another. Neither passes ``inline``; the rows are the same.
        """
        return getattr(self, name).select(F.inline(F.array(F.struct(*columns))))

    def arriving(self, name: str) -> DataFrame:
        """A given table as a file stream."""
        # a file stream takes folders or patterns, and a table may be a single file
        path = f"{self._folder}/{name}.{{parquet}}"
        return self._spark.readStream.schema(self.given(name).schema).parquet(path)

    def streamed(self, view: str, source: str = "events") -> DataFrame:
        """A derived table over an arriving given table."""
        return self.sql(VIEWS[view], **{source: self.arriving(source)})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return self.sql(VIEWS[name])


def duck_view(name: str) -> str:
    """The view's text with the given tables named plainly."""
    return VIEWS[name].format(**{g: g for g in GIVEN}).strip()


def with_views(names: list[str], body: str) -> str:
    """A statement with the views it reads as common table expressions."""
    head = ",\n".join(f"{name} as ({duck_view(name)})" for name in names)
    return f"with recursive {head}\n{body.lstrip()}" if "recursive" in body else f"with {head}\n{body.lstrip()}"
