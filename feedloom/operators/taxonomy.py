"""Taxonomy and gazetteer lookups as joins. Spark broadcasts a lookup only when its size allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.places import geo_query
from feedloom.operators.ordinals import last_per_key

NAMED = "struct<id:int,name:string>"
# The nesting of a job function, from the discipline down to the sector.
JOB_FUNCTION = (
    "struct<id:int,name:string,discipline_detail:struct<sub_industry_detail:struct<industry_detail:"
    "struct<id:int,name:string,industry_group_detail:struct<id:int,name:string,sector_detail:"
    f"{NAMED}>>>>>"
)


def attach_functions(rows: DataFrame, functions: DataFrame, key: str = "industry_id") -> DataFrame:
    """Add ``job_functions`` of the industry, an empty list when it has none."""
    joined = rows.drop("job_functions").join(functions.select(key, "job_functions"), key, "left")
    return joined.withColumn("job_functions", F.coalesce("job_functions", F.array()))


def function_names(functions: DataFrame, key: str = "industry_id") -> DataFrame:
    """``(job_function_id, sector, industry_group, industry)`` from the nested lists of all industries.

    A function listed under several industries counts once, in the order of the industries.
    """
    one = functions.select(F.col(key).alias("listed_under"), F.explode("job_functions").alias("f"))
    industry = "f.discipline_detail.sub_industry_detail.industry_detail"
    flat = one.select(
        F.col("f.id").alias("job_function_id"),
        "listed_under",
        F.col(f"{industry}.industry_group_detail.sector_detail.name").alias("sector"),
        F.col(f"{industry}.industry_group_detail.name").alias("industry_group"),
        F.col(f"{industry}.name").alias("industry"),
    ).filter("job_function_id IS NOT NULL")
    return last_per_key(flat, "job_function_id", "listed_under").drop("listed_under")


def attach_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Add the three names of the row's job function, '' where it is unknown."""
    labels = ["sector", "industry_group", "industry"]
    joined = rows.drop(*labels).join(names, "job_function_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in labels})


def attach_coordinates(rows: DataFrame, gazetteer: DataFrame, locations: str = "locations") -> DataFrame:
    """Add ``_geo`` by the lookup key of the locations; ``gazetteer`` has ``query``, ``lat``, ``lng``.

    A known place without coordinates and an unknown place both give null.
    """
    known = gazetteer.select(
        F.col("query").alias("geo_key"),
        F.when(F.col("lat").isNotNull() & F.col("lng").isNotNull(), F.struct("lat", "lng")).alias("_geo"),
    )
    return rows.drop("_geo").withColumn("geo_key", geo_query(F.col(locations))).join(known, "geo_key", "left")


def unknown_places(rows: DataFrame, gazetteer: DataFrame, locations: str = "locations") -> DataFrame:
    """The distinct lookup keys the gazetteer does not hold yet."""
    asked = rows.select(geo_query(F.col(locations)).alias("query")).filter("query IS NOT NULL").distinct()
    return asked.join(gazetteer.select("query"), "query", "left_anti")
