"""Basket views over the star-schema and event tables, as ``(tid, item)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _order_part(spark: SparkSession, sf_dir: str, attribute: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", attribute)
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("tid"), F.col(attribute).alias("item")
    )


def order_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands of the parts in each order."""
    return _order_part(spark, sf_dir, "p_brand")


def order_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part types in each order."""
    return _order_part(spark, sf_dir, "p_type")


def order_small_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands of the small parts in each order; other parts are no item.

    Many orders have no small part: they are transactions without items.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_size")
    item = F.when(F.col("p_size") <= 10, F.col("p_brand")).otherwise("")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("tid"), item.alias("item")
    )


def customer_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands that each customer has ordered: dense baskets."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    bought = order_brand(spark, sf_dir)
    return bought.join(orders, F.col("tid") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("tid"), "item"
    )


def userday_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types of each user on each day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat_ws("|", F.col("user_id").cast("string"), day).alias("tid"),
        F.col("event_type").alias("item"),
    )


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document: its whole text, split at single spaces."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("tid"), F.explode(F.split("text", " ")).alias("item")
    )


BASKET_VIEWS = {
    "order_brand": order_brand,
    "order_type": order_type,
    "order_small_brand": order_small_brand,
    "customer_brand": customer_brand,
    "userday_event": userday_event,
    "document_words": document_words,
}


def basket_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BASKET_VIEWS[name](spark, sf_dir)
