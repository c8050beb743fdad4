"""From raw feed fields to the fixed posting layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import places, text
from feedloom.functions.hashing import canonical_hash
from feedloom.sources.feeds import mapped_fields

# Raw field names of the known feeds and the posting fields they fill.
ALIASES = {
    "company": "company_name",
    "company_name": "company_name",
    "companyName": "company_name",
    "hiring_organization": "company_name",
    "hiringOrganization": "company_name",
    "employer": "company_name",
    "body": "description",
    "description": "description",
    "jobDescription": "description",
    "job_description": "description",
    "full_description": "description",
    "details": "description",
    "job_details": "description",
    "date": "posted_at",
    "posted_at": "posted_at",
    "datePosted": "posted_at",
    "date_posted": "posted_at",
    "publication_date": "posted_at",
    "post_date": "posted_at",
    "url": "application_url",
    "job_url": "application_url",
    "applyLink": "application_url",
    "application_link": "application_url",
    "apply_url": "application_url",
    "link": "application_url",
    "title": "title",
    "jobTitle": "title",
    "job_title": "title",
    "position_title": "title",
    "position": "title",
    "role": "title",
    "location": "locations",
    "jobLocations": "locations",
    "job_location": "locations",
    "address": "locations",
    "work_location": "locations",
    "city_state": "locations",
    "city": "locations",
    "state": "locations",
    "country": "locations",
    "job-type": "employment_type",
    "job_type": "employment_type",
    "jobType": "employment_type",
    "type": "employment_type",
    "position_type": "employment_type",
    "contract_type": "employment_type",
    "employmentType": "employment_type",
    "referencenumber": "external_job_id",
    "ref_id": "external_job_id",
    "jobID": "external_job_id",
    "job_id": "external_job_id",
    "reference_id": "external_job_id",
    "requisition_id": "external_job_id",
    "job_reference": "external_job_id",
    "remote": "is_remote",
    "is_remote": "is_remote",
    "isRemote": "is_remote",
    "salary_min": "salary_min",
    "min_salary": "salary_min",
    "minimum_salary": "salary_min",
    "salary_from": "salary_min",
    "salary_max": "salary_max",
    "max_salary": "salary_max",
    "maximum_salary": "salary_max",
    "salary_to": "salary_max",
    "salary_period": "salary_period",
    "salary_frequency": "salary_period",
    "pay_period": "salary_period",
    "currency": "currency",
    "salary_currency": "currency",
}

# Partner ids by company name.
PARTNERS = {
    "appcast": 6, "buyer": 7, "veritone": 8, "joveo": 9, "csquared": 10,
    "irecruitics": 11, "zip recruiter": 12, "sample": 13, "recruitics": 14, "job target": 15,
}

# Names of enrichment results and the columns they are stored in.
STORED_NAMES = {
    "reasoning_industry": "ih_reasoning",
    "reasoning_confidence": "confidence_reasoning",
    "reasoning": "jf_reasoning",
    "confidence_score": "ai_confidence_score",
}

# The stored posting. A default is used only where the column is absent.
LIST = "array<string>"
LOCATIONS = f"array<{places.LOCATION}>"
POSTING = {
    "bigquery_id": "string", "external_job_id": "string", "job_hash": "string", "title": "string",
    "company_name": "string", "description": "string", "locations": LOCATIONS, "is_multi_location": "boolean",
    "is_remote": "boolean", "is_international": "boolean", "application_url": "string",
    "posted_at": "timestamp_ntz", "employment_type": "string", "status": "string",
    "ai_confidence_score": "double", "ai_enrichment_status": "string", "ai_enrichment_error": "string",
    "ai_title": "string", "ai_description": "string", "ai_job_tasks": LIST, "ai_search_terms": LIST,
    "ai_top_tags": LIST, "ai_skills": LIST, "sector_id": "int", "industry_group_id": "int", "industry_id": "int",
    "job_function_id": "int", "sector": "string", "industry_group": "string", "industry": "string",
    "ih_reasoning": "string", "jf_reasoning": "string", "confidence_reasoning": "string", "salary_min": "double",
    "salary_max": "double", "salary_period": "string", "currency": "string", "cpc": "double", "cpa": "double",
    "feed_id": "int", "execution_id": "int", "job_source": "string", "created_at": "timestamp_ntz",
    "updated_at": "timestamp_ntz", "partner_id": "int", "location_string": "string",
    "_geo": "struct<lat:double,lng:double>", "searchable_text": "string",
}
EMPTY_LISTS = ["ai_job_tasks", "ai_search_terms", "ai_top_tags", "ai_skills", "locations"]
ZEROS = ["cpc", "cpa", "ai_confidence_score", "salary_min", "salary_max"]
FALSES = ["is_multi_location", "is_remote", "is_international"]


def apply_aliases(raw: DataFrame, targets: Sequence[str], aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Rename the raw columns to posting fields and keep only ``targets``; the last filled one wins.

    Names without an alias stay as they are. Tags are compared exactly, as alias tables hold both cases.
    """
    present = {name: aliases.get(name, name) for name in raw.columns}
    wanted = {name: target for name, target in present.items() if target in targets}
    return raw.select(*mapped_fields(wanted, lambda name: F.col(f"`{name}`")))


def merge_mappings(old: Column, new: Column) -> Column:
    """The old mapping with the entries of the new one laid over it."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def standardise(df: DataFrame, schema_fields: Sequence[str] | None = None) -> DataFrame:
    """Typed posting fields from mapped texts.

    Entities are resolved in every text. Status, employment type, flags and amounts are typed when
    they belong to ``schema_fields`` (all by default) and the value is there; places become a list.
    """
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    columns = set(df.columns)
    typed = columns if schema_fields is None else columns & set(schema_fields)
    out: dict[str, Column] = {}
    for name in df.columns:
        if name in ("city", "state", "country", "locations"):
            continue
        value = text.unescape_entities(F.col(name)) if name in strings else F.col(name)
        if name in typed:
            if name == "status":
                value = F.when(value.isNotNull(), text.posting_status(value))
            elif name == "employment_type":
                value = F.when(value.isNotNull(), text.employment_type(value))
            elif name.startswith("is_"):
                value = text.truth(value)
            elif name.startswith("salary_") or name in ("cpc", "cpa"):
                value = text.number(value) if name != "salary_period" else value
        out[name] = value

    def part(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast("string")

    out["locations"] = places.locations_from_columns(part("city"), part("state"), part("country"), part("locations"))
    return df.select(*[value.alias(name) for name, value in out.items()])


def drop_closed(df: DataFrame) -> DataFrame:
    """Everything but CLOSED; a missing status stays."""
    return df.filter(~F.col("status").eqNullSafe("CLOSED"))


def partner_id(company: Column, partners: Mapping[str, int] = PARTNERS) -> Column:
    pairs = [F.lit(x) for pair in partners.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.lower(text.strip(company)))


def finalise(df: DataFrame, feed_id: Column, feed_name: Column, partner: Column, run_time: datetime) -> DataFrame:
    """Stored column names, feed and partner, and the times of the run."""
    renames = {old: new for old, new in STORED_NAMES.items() if old in df.columns}
    now = F.lit(run_time).cast("timestamp_ntz")
    created = F.coalesce(F.col("created_at"), now) if "created_at" in df.columns else now
    return df.withColumnsRenamed(renames).withColumns(
        {
            "feed_id": feed_id, "partner_id": partner, "job_source": feed_name,
            "created_at": created, "updated_at": now,
        }
    )


def conform(df: DataFrame) -> DataFrame:
    """Exactly the stored posting: absent columns get their default, a missing hash is computed."""

    def column(name: str, kind: str) -> Column:
        if name in df.columns:
            value = F.col(name)
        elif name in EMPTY_LISTS:
            value = F.array()
        elif name in ZEROS:
            value = F.lit(0.0)
        elif name in FALSES:
            value = F.lit(False)
        else:
            value = F.lit(None)
        if name == "job_hash":
            value = F.coalesce(F.nullif(value.cast("string"), F.lit("")), canonical_hash())
        return value.cast(kind).alias(name)

    return df.select(*[column(name, kind) for name, kind in POSTING.items()])


def migrate_feeds(old: DataFrame) -> DataFrame:
    """Rows of the former feeds table in the present layout; absent source columns become null."""

    def source(name: str, kind: str) -> Column:
        return (F.col(name) if name in old.columns else F.lit(None)).cast(kind)

    def filled(name: str) -> Column:
        return F.coalesce(source(name, "string"), F.lit(""))

    active = source("status", "string").eqNullSafe("active") if "status" in old.columns else F.lit(True)
    nothing = F.lit(None)
    layout = {
        "name": source("name", "string"),
        "source_url": source("feed_url", "string"),
        "feed_type": source("feed_type", "string"),
        "parser_type": filled("parser_type"),
        "company_name": filled("company"),
        "is_active": active,
        "check_frequency_minutes": source("polling_interval", "int"),
        "last_checked_at": source("last_polled", "timestamp"),
        "next_check_at": nothing.cast("timestamp"),
        "last_run_status": nothing.cast("string"),
        "last_succeeded_at": source("last_processed_at", "timestamp"),
        "consecutive_failure_count": source("error_count", "int"),
        "last_error_message": source("error_message", "string"),
        "created_at": source("created_at", "timestamp"),
        "updated_at": source("updated_at", "timestamp"),
        "unique_jobs_processed": source("processed_jobs_count", "int"),
        "cw_auto_approved_jobs": nothing.cast("int"),
        "avg_processing_time": source("avg_processing_time", "int"),
        "error_count": source("error_count", "int"),
        "avg_feed_size": nothing.cast("double"),
    }
    return old.select(*[value.alias(name) for name, value in layout.items()])
