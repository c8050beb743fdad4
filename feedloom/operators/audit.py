"""Profiles of unknown feeds and checks of stored data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.hashing import base64_sha256, canonical_hash
from feedloom.functions.text import clean_for_hash, ellipsis


def preview(rows: DataFrame, limit: int = 5, length: int = 100) -> DataFrame:
    """A few rows for display with shortened descriptions."""
    few = rows.limit(limit)
    return few.withColumn("description", ellipsis(F.col("description"), length)) if "description" in rows.columns else few


def tag_profile(tags: DataFrame, mappings: dict[str, str] | None = None) -> DataFrame:
    """Per tag: rows that have it, rows that fill it, distinct values, and the target it is mapped to.

    ``tags`` holds one row per (tag, value). Values are first made distinct per tag by their digest,
    with partial aggregation, so long texts are not shuffled, and then counted.
    """
    marked = tags.select(
        "tag", F.sha2("value", 256).alias("digest"), F.coalesce(F.col("value") != "", F.lit(False)).alias("is_filled")
    )
    values = marked.groupBy("tag", "digest", "is_filled").agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("is_filled")
    profile = values.groupBy("tag").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("filled"),
        F.count_if(filled).alias("distinct_values"),
    )
    if mappings is None:
        return profile
    lowered = {k.lower(): v for k, v in mappings.items()}
    target = F.lit(None).cast("string")
    if lowered:
        pairs = [F.lit(x) for pair in lowered.items() for x in pair]
        target = F.element_at(F.create_map(*pairs), F.lower("tag"))
    return profile.withColumn("target", target).withColumn("is_mapped", F.col("target").isNotNull())


def map_keys_profile(records: DataFrame, col: str) -> DataFrame:
    """The distinct keys of a map column with the number of rows that have them."""
    return records.select(F.explode(F.map_keys(col)).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("rows"))


def rehash(rows: DataFrame, company: str = "company_name") -> DataFrame:
    """Per stored hash: rows and rows whose content now gives another hash."""
    fresh = rows.withColumn("fresh", canonical_hash(company=company))
    return fresh.groupBy("job_hash").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("fresh").eqNullSafe(F.col("job_hash"))).alias("mismatches")
    )


def verify_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whether a copy is complete: counts, schema and rows, from one aggregate over both sides.

    Rows are compared as multisets by the digest of their whole content, so only digests are shuffled.
    """
    if source.dtypes != target.dtypes:
        sides = source.select(F.lit(1).alias("_side")).unionByName(target.select(F.lit(-1).alias("_side")))
        return sides.agg(
            F.count_if(F.col("_side") == 1).alias("source_count"), F.count_if(F.col("_side") == -1).alias("dest_count")
        ).select(
            "source_count", "dest_count", (F.col("source_count") == F.col("dest_count")).alias("counts_match"),
            F.lit(False).alias("rows_match"), F.lit(False).alias("schema_match"),
        )
    content = F.sha2(F.to_json(F.struct(*source.columns)), 256).alias("digest")
    marked = source.select(content, F.lit(1).alias("_side")).unionByName(target.select(content, F.lit(-1).alias("_side")))
    balance = marked.groupBy("digest").agg(
        F.count_if(F.col("_side") == 1).alias("in_source"), F.count_if(F.col("_side") == -1).alias("in_dest")
    )
    return balance.agg(
        F.coalesce(F.sum("in_source"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("in_dest"), F.lit(0)).alias("dest_count"),
        F.count_if(F.col("in_source") != F.col("in_dest")).alias("differing"),
    ).select(
        "source_count", "dest_count", (F.col("source_count") == F.col("dest_count")).alias("counts_match"),
        (F.col("differing") == 0).alias("rows_match"), F.lit(True).alias("schema_match"),
    )


# The lengths and spellings tried when the origin of a hash is looked for.
CUTS = [50, 100, 200, 500, 1000]
TYPES = ["Full-time", "Part-time", "FULL_TIME", "PART_TIME"]


def hash_recipes(title: Column, company: Column, description: Column, cleaned: Column) -> Column:
    """All ways a stored hash may have been made from a row, as an array of ``(recipe, hash)``.

    Title alone, with company, with type, and with the description raw or cleaned, whole or cut.
    """
    blank = F.lit("")
    texts = {"raw": description, "clean": cleaned}
    texts |= {f"raw {n}": F.substring(description, 1, n) for n in CUTS}
    texts |= {f"clean {n}": F.substring(cleaned, 1, n) for n in CUTS}

    def recipe(name: str, *parts: Column) -> Column:
        return F.struct(F.lit(name).alias("recipe"), base64_sha256(F.concat_ws("|", *parts)).alias("job_hash"))

    return F.array(
        recipe("title", title, blank, blank, blank),
        recipe("title, company", title, company, blank, blank),
        *[recipe(f"title, company, {t}", title, company, F.lit(t), blank) for t in TYPES],
        *[recipe(f"title, company, {t}, {n}", title, company, F.lit(t), x) for t in TYPES for n, x in texts.items()],
    )


def find_hash_source(rows: DataFrame, targets: DataFrame, id_col: str = "seq") -> DataFrame:
    """``(job_hash, id, recipe)`` for every wanted hash that some row can produce.

    Each row tries its own fields, so the work grows with the rows and the wanted hashes are met by
    an equi-join. Pools of unrelated fields are not multiplied with each other.
    """
    blank = F.lit("")
    ready = rows.select(
        F.col(id_col).alias("id"),
        *[F.coalesce(c, blank).alias(c) for c in ("title", "company_name", "description")],
        clean_for_hash(F.col("description")).alias("cleaned"),
    )
    recipes = hash_recipes(F.col("title"), F.col("company_name"), F.col("description"), F.col("cleaned"))
    tried = ready.select("id", F.explode(recipes).alias("r")).select("id", "r.recipe", "r.job_hash")
    return tried.join(targets.select("job_hash").distinct(), "job_hash")
