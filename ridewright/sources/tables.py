"""Stored tables and landed quote files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.functions import messages, money
from ridewright.operators.lookup import latest_per_key

# Currencies whose rates are fetched.
CURRENCIES = ["USD", "ILS"]


def table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; give ``schema`` to skip reading a footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def on_dates(rides: DataFrame, days: Sequence[date]) -> DataFrame:
    """Rides of the given days; on a table partitioned by effective_date only those are read."""
    return rides.where(F.col("effective_date").isin([F.lit(d) for d in days]))


def currency_table(spark: SparkSession, currencies: Sequence[str] = CURRENCIES) -> DataFrame:
    return spark.createDataFrame([(c,) for c in currencies], "currency_code string")


def _quote_schema(token: str) -> T.StructType:
    price = T.StructType([T.StructField("price", T.DecimalType(11, 6))])
    quotes = T.StructType([T.StructField("quote", T.MapType(T.StringType(), price))])
    return T.StructType([T.StructField("data", T.StructType([T.StructField(token, quotes)]))])


def latest_rates(responses: DataFrame, token: str, currencies: Sequence[str] = CURRENCIES) -> DataFrame:
    """Newest rate per currency from landed quote responses (status, body, ts).

    Responses that are not 200 or not readable are skipped.
    """
    parsed = responses.where(F.col("status") == 200).withColumn(
        "_quote", messages.from_message(F.col("body"), _quote_schema(token))
    )
    quotes = (
        parsed.where(F.col(f"_quote.{messages.CORRUPT}").isNull())
        .select("ts", F.explode(F.col(f"_quote.data.{token}.quote")).alias("currency_code", "q"))
        .select("currency_code", F.col("q.price").cast(money.RATE).alias("rate"), F.col("ts").alias("updated_timestamp"))
        .where(F.col("currency_code").isin(*currencies) & F.col("rate").isNotNull())
    )
    return latest_per_key(quotes, ["currency_code"], ["updated_timestamp", "rate"])
