"""Published records, search documents, payload batches and the outcome of sending them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import dates, places, text
from feedloom.operators.ordinals import batches
from feedloom.operators.tables import stable_id
from feedloom.session import materialise
from feedloom.sources import sinks

# Rows per payload for the mirror and for the search index.
MIRROR_ROWS, SEARCH_ROWS = 250, 100

# Published field, source column and the default for an absent column.
TEXTS = {
    "external_job_id": "", "job_hash": "", "application_url": "", "title": "", "description": "", "ai_title": "",
    "ai_description": "", "salary_period": "", "location_string": "", "ai_enrichment_status": "",
    "ai_enrichment_error": "", "sector": "", "industry_group": "", "industry": "", "searchable_text": "",
    "company_logo_url": "",
}
FLAGS = ["is_multi_location", "is_remote", "is_international"]
AMOUNTS = ["salary_min", "salary_max", "cpc", "cpa"]
IDS = ["sector_id", "industry_group_id", "industry_id", "job_function_id"]
FILLED_IDS = ["feed_id", "execution_id", "partner_id"]
LISTS = ["ai_job_tasks", "ai_skills", "ai_search_terms", "ai_top_tags"]


def published(rows: DataFrame, eid: Column | None = None) -> DataFrame:
    """The mirror record of each posting. ``eid`` defaults to an id that depends only on the hash."""
    have = set(rows.columns)

    def column(name: str, default: Column) -> Column:
        return F.col(name) if name in have else default

    nothing = F.lit(None)
    kinds = dict(rows.dtypes)
    if "posted_at" not in have:
        posted = F.lit(0).cast("long")
    elif kinds["posted_at"] == "string":
        posted = dates.epoch_millis(F.col("posted_at"))
    elif kinds["posted_at"].startswith("timestamp"):
        posted = F.coalesce(F.unix_millis(F.col("posted_at").cast("timestamp")), F.lit(0).cast("long"))
    else:
        posted = dates.epoch_number_to_millis(F.col("posted_at"))
    kind = column("employment_type", nothing.cast("string"))
    score = text.number(column("ai_confidence_score", nothing.cast("double")), 0.0)
    empty_places = F.array().cast(f"array<{places.LOCATION}>")
    out = {
        "bigquery_id": column("bigquery_id", nothing.cast("string")),
        "eid": F.regexp_replace(stable_id("job_hash"), "-", "") if eid is None else eid,
        **{name: column(name, F.lit(default)) for name, default in TEXTS.items()},
        **{name: column(name, F.lit(False)) for name in FLAGS},
        **{name: text.number(column(name, nothing.cast("double")), 0.0) for name in AMOUNTS},
        **{name: column(name, F.lit(0)) for name in IDS},
        "_geo": column("_geo", nothing.cast("struct<lat:double,lng:double>")),
        **{name: F.coalesce(column(name, F.lit(0)), F.lit(0)).cast("int") for name in FILLED_IDS},
        "status": column("status", F.lit("ACTIVE")),
        "company": column("company_name", F.lit("")),
        "location": column("locations", empty_places),
        "posted_at": posted,
        "ai_confidence_score": score.cast("int"),
        "employment_type": F.when(kind == "FULL_TIME", "Full-time").otherwise("Part-time"),
        **{name: column(name, F.array().cast("array<string>")) for name in LISTS},
    }
    return rows.select(*[value.alias(name) for name, value in out.items()])


def search_documents(records: DataFrame) -> DataFrame:
    """``(id, content, metadata)`` of mirror records; records without an id are left out."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    content = F.struct(
        F.substring(filled("searchable_text"), 1, 2500).alias("searchableText"),
        F.col("title"),
        F.col("company"),
        text.plain_excerpt(F.col("ai_description"), 400).alias("description"),
        F.substring(places.location_string(F.col("location")), 1, 800).alias("location"),
        F.col("employment_type"),
        F.col("is_remote"),
        F.col("sector"),
        F.col("industry"),
    )
    metadata = F.struct(
        F.col("company_logo_url").alias("logo_url"), F.col("application_url"), F.col("posted_at"), F.col("eid"),
        F.col("feed_id"),
    )
    return records.filter(filled("eid") != "").select(
        F.col("eid").alias("id"), content.alias("content"), metadata.alias("metadata")
    )


def payloads(rows: DataFrame, order: str, size: int, item: Column, keys: tuple[str, ...] = (), **how) -> DataFrame:
    """One JSON payload of at most ``size`` items per row."""
    return batches(rows, list(keys), order, size, item, **how).withColumn("payload", F.to_json("items")).drop("items")


# The actions of a sync, with rows per call and the field that holds them.
ACTIONS = {
    "mirror_delete": (MIRROR_ROWS, "job_hashes"),
    "mirror_add": (MIRROR_ROWS, "job_postings"),
    "search_delete": (SEARCH_ROWS, "ids"),
    "search_upsert": (SEARCH_ROWS, "documents"),
}


def action_batches(
    rows: DataFrame, action: str, run: str, order: str, item: Column | None = None, keys: tuple[str, ...] = (), **how
) -> DataFrame:
    """The calls of one action, one row each, for the sink of ``sources.sinks``.

    ``(action, batch_key, <keys>, batch_no, batch_rows, payload)``; the payload is JSON with the items under the
    action's field, in the order of the unique column ``order``. The key depends on the run, the action and the
    batch alone, so the same call has the same key in every try.
    """
    size, field = ACTIONS[action]
    batched = batches(rows, list(keys), order, size, F.col(order) if item is None else item, **how)
    key = F.sha2(F.concat_ws("\x01", F.lit(run), F.lit(action), *[F.col(k).cast("string") for k in keys], F.col("batch_no").cast("string")), 256)
    return batched.select(
        F.lit(action).alias("action"), key.alias("batch_key"), *keys, "batch_no", "batch_rows",
        F.to_json(F.struct(F.col("items").alias(field))).alias("payload"),
    )


def _by_hash(rows: DataFrame, action: str, run: str, order: str, item: Column | None = None) -> DataFrame:
    """Batches in the order of a text column that is spread by its first two characters."""
    ranged = rows.withColumn("_prefix", F.substring(order, 1, 2))
    return action_batches(ranged, action, run, order, item, range_of=F.col("_prefix"))


def sync_batches(
    run: str, records: DataFrame, deleted: DataFrame, documents: DataFrame, deleted_ids: DataFrame
) -> dict[str, DataFrame]:
    """The calls of a whole sync by action, in the order they are to be made: both deletions come first.

    ``records`` are mirror records, ``deleted`` holds ``job_hash``; ``documents`` are search documents with a
    unique ``id``, ``deleted_ids`` holds ``id``. Null keys are left out.
    """
    hashes = deleted.select("job_hash").filter("job_hash IS NOT NULL").distinct()
    ids = deleted_ids.select("id").filter("id IS NOT NULL").distinct()
    return {
        "mirror_delete": _by_hash(hashes, "mirror_delete", run, "job_hash"),
        "search_delete": _by_hash(ids, "search_delete", run, "id"),
        "mirror_add": _by_hash(records.filter("job_hash IS NOT NULL"), "mirror_add", run, "job_hash", F.struct(*records.columns)),
        "search_upsert": _by_hash(documents, "search_upsert", run, "id", F.struct(*documents.columns)),
    }


def sync(calls: dict[str, DataFrame], send: sinks.Send, journal: str, at_once: int | None = None, **how) -> DataFrame:
    """Make all calls, one action after another, and return their outcomes.

    The calls are written before they are made, so a repeated task sends what it sent before.
    """
    spark = next(iter(calls.values())).sparkSession
    for action, rows in calls.items():
        sinks.send_batches(materialise(rows, action), send, journal, at_once=at_once, **how)
    return sinks.outcomes(spark, journal)


Writer = Callable[[str], int]


def send_payloads(payload_rows: DataFrame, send: Writer, retries: int = 3, delay: float = 5.0) -> DataFrame:
    """Call ``send`` once per payload and return the outcome per batch as rows."""
    kept = [f for f in payload_rows.schema.fields if f.name != "payload"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            outcome = [sinks.send_outcome(lambda p=p: send(p), retries, delay) for p in frame["payload"]]
            done = pd.DataFrame(outcome, columns=["ok", "attempts", "error"], index=frame.index)
            yield pd.concat([frame.drop(columns="payload"), done], axis=1)

    return payload_rows.mapInPandas(run, f"{ddl}, ok boolean, attempts int, error string")
