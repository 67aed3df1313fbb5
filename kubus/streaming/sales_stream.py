"""Incremental sales load with Structured Streaming.

New sales files dropped into a folder are parsed and classified exactly as
the batch load does (stream-static left joins against the dimensions) and
appended to a Parquet file sink, partitioned by load status and sale year.
The file sink plus a checkpoint folder make the load exactly-once across
restarts and executor loss; ``trigger(availableNow=True)`` processes what is
there and stops, which replaces the source system's 1,000-row commit loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import facts as FT
from ..sources.sales_text import SALES_SCHEMA


def read_sales_stream(spark: SparkSession, folder: str, encoding: str = "ISO-8859-1",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Files with the header ``Date;Shop;Article;Sold;Revenue``; any other
    header fails the query instead of filling the wrong columns."""
    reader = (spark.readStream.schema(SALES_SCHEMA).option("header", True)
              .option("enforceSchema", False).option("escape", '"')
              .option("sep", ";").option("encoding", encoding))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def start_sales_load(spark: SparkSession, folder: str, dim_shop: DataFrame,
                     dim_product: DataFrame, dim_date: DataFrame, out: str,
                     checkpoint: str, available_now: bool = True) -> StreamingQuery:
    classified = FT.classify_sales(read_sales_stream(spark, folder), dim_shop,
                                   dim_product, dim_date)
    rows = classified.select(
        "*",
        F.when(F.col("reject_reason").isNull(), F.lit("accepted"))
        .otherwise(F.lit("rejected")).alias("load_status"),
        F.coalesce(F.expr("CAST(sale_date_key DIV 10000 AS INT)"), F.lit(0)).alias("sale_year"))
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .partitionBy("load_status", "sale_year"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(out)


def loaded_fact(spark: SparkSession, out: str) -> DataFrame:
    """Accepted rows of the sink as fact rows (reads the sink's log, so
    only committed files are seen)."""
    return FT.accepted(spark.read.parquet(out).where(F.col("load_status") == "accepted"))


def loaded_rejects(spark: SparkSession, out: str) -> DataFrame:
    return FT.rejected(spark.read.parquet(out).where(F.col("load_status") == "rejected"))
