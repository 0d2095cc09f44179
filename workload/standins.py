"""The ticket model's inputs, made from the test tables by renaming and nesting columns.

The dimensions are filtered so that some facts have no match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.sources import read_table


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read_table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date").cast("string")
    return line.select(
        day.alias("search_date"),
        F.col("l_shipdate").cast("string").alias("found_at"),
        day.alias("depart_date"),
        F.col("l_linenumber").cast("double").alias("number_of_changes"),
        F.col("l_tax").alias("trip_class"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_returnflag").alias("origin"),
        F.col("l_partkey").cast("string").alias("destination"),
        F.col("l_suppkey").cast("string").alias("airline"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("code"),
        F.col("s_name").alias("name"),
        F.struct(F.replace("s_name", F.lit("#"), F.lit("'")).alias("en")).alias(
            "name_translations"
        ),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_airports(spark, sf_dir).filter("coordinates.lon <= 25")


def all_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("code"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("name"),
        F.struct(F.replace("p_name", F.lit(" "), F.lit("'")).alias("en")).alias(
            "name_translations"
        ),
        F.struct(
            F.col("p_retailprice").alias("lat"), F.col("p_size").cast("double").alias("lon")
        ).alias("coordinates"),
        F.col("p_brand").alias("city_code"),
        F.col("p_brand").alias("country_code"),
        F.replace("p_type", F.lit(" "), F.lit("/")).alias("time_zone"),
        F.col("p_type").alias("iata_type"),
        (F.col("p_size") <= 10).alias("flightable"),
    )
