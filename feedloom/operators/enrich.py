"""Enrichment: caches, batches, a user function per batch, and laying results over the rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import clean_html, join_terms
from feedloom.operators.ordinals import batches
from feedloom.session import discard, materialise, materialise_observed, noted

BATCH_ROWS = 10
#: What the first row of a batch carries of the whole call.
SPENT = ("calls", "input_tokens", "output_tokens")
SUCCESS, FAILED = "success", "failed"

# Texts of failed rows, and the largest context of a prompt in characters.
MISMATCH = "AI response length mismatch"
TOO_LARGE = "Single job exceeds model token limit"
BATCH_FAILED = "Batch processing failed with exception: "
MISSING_DATA = "Missing data for function classification"
WEEK_SECONDS = 60 * 60 * 24 * 7

# The results of the three enrichment steps.
ATTRIBUTES = (
    "ai_title string, ai_description string, ai_job_tasks array<string>, ai_search_terms array<string>, "
    "ai_top_tags array<string>, ai_skills array<string>, salary_min double, salary_max double, "
    "salary_period string, currency string, sector_id int, industry_group_id int, industry_id int, "
    "reasoning_industry string, confidence_score double, reasoning_confidence string"
)
SELECTION = "job_function_id int, reasoning string"
SEARCHABLE = "searchable_text string"


class TooLarge(Exception):
    """Raised by a batch function when the batch must be cut in two."""


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def overlay(rows: DataFrame, result: str, fields: Sequence[str]) -> DataFrame:
    """Lay the fields of a result struct over the row; null results keep the row's own value."""
    out = {}
    for name in fields:
        new = F.col(f"{result}.{name}")
        out[name] = F.coalesce(new, F.col(name)) if name in rows.columns else new
    return rows.withColumns(out).drop(result)


def cache_hits(rows: DataFrame, cache: DataFrame, key: str = "job_hash") -> tuple[DataFrame, DataFrame]:
    """``(hits, misses)``: hits carry the cached ``result``, misses are the rows as they came."""
    hits = rows.join(cache.select(key, "result"), key)
    return hits, rows.join(cache.select(key), key, "left_anti").select(*rows.columns)


def is_fresh(saved: Column, now: Column, lifetime: int = WEEK_SECONDS) -> Column:
    """Whether a cache entry, saved at a number of seconds since 1970, is younger than its lifetime."""
    return F.coalesce(now - saved < lifetime, F.lit(False))


def ids_to_fetch(rows: DataFrame, cache: DataFrame, key: str, now: Column) -> DataFrame:
    """Distinct keys of the rows without a fresh cache entry. ``cache`` has the key and ``timestamp``."""
    fresh = cache.filter(is_fresh(F.col("timestamp"), now)).select(key)
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().join(fresh, key, "left_anti")


def parse_response(col: Column, ddl: str, name: str) -> Column:
    """The objects of a response ``{name: [...]}``; whatever is no object is dropped."""
    raw = F.from_json(col, T.StructType([T.StructField(name, T.ArrayType(T.StringType()))]))[name]
    objects = F.filter(raw, lambda x: x.rlike(r"(?s)^\s*\{"))
    return F.transform(objects, lambda x: F.from_json(x, struct_type(ddl)))


def zip_results(batched: DataFrame, items: str = "items", results: str = "results") -> DataFrame:
    """Match results to items by position. A batch with another number of results fails as a whole."""
    keys = [c for c in batched.columns if c not in (items, results)]
    fits = F.coalesce(F.size(items) == F.size(results), F.lit(False))
    exploded = batched.withColumn("_fits", fits).select(
        *keys, "_fits", results, F.posexplode(items).alias("position", "item")
    )
    return exploded.select(
        *keys,
        "position",
        "item",
        F.when(F.col("_fits"), F.get(F.col(results), F.col("position"))).alias("result"),
        F.when(F.col("_fits"), SUCCESS).otherwise(FAILED).alias("ai_enrichment_status"),
        F.when(~F.col("_fits"), MISMATCH).alias("ai_enrichment_error"),
    )


#: One result per row; with the tokens of the call, ``(results, (input_tokens, output_tokens))``.
BatchFunction = Callable[[list[dict]], "list[dict] | tuple[list[dict], tuple[int, int]]"]


def answer(fn: BatchFunction, rows: list[dict], retries: int, delay: float) -> tuple[list[tuple], tuple[int, int, int]]:
    """``(result, status, error)`` per row, and the calls with their input and output tokens. Failures become rows."""
    calls, error, tokens = 0, "", (0, 0)

    def used() -> tuple[int, int, int]:
        return (calls, *tokens)

    for attempt in range(retries):
        calls += 1
        try:
            found = fn(rows)
            if isinstance(found, tuple):
                found, spent = found
                tokens = (tokens[0] + spent[0], tokens[1] + spent[1])
        except TooLarge:
            if len(rows) == 1:
                return [({}, FAILED, TOO_LARGE)], used()
            middle = len(rows) // 2
            left, right = (answer(fn, part, retries, delay) for part in (rows[:middle], rows[middle:]))
            return left[0] + right[0], tuple(map(sum, zip(used(), left[1], right[1])))
        except Exception as problem:  # noqa: BLE001 - any failure of the user function is a failed row
            error = f"{BATCH_FAILED}{str(problem)[:100]}"
            if attempt + 1 < retries:
                time.sleep(delay * 2**attempt)
            continue
        if len(found) != len(rows):
            return [({}, FAILED, MISMATCH)] * len(rows), used()
        return [(result, SUCCESS, None) for result in found], used()
    return [({}, FAILED, error)] * len(rows), used()


def run_batches(
    batched: DataFrame, fn: BatchFunction, ddl: str, key: str = "job_hash", retries: int = 3, delay: float = 2.0
) -> DataFrame:
    """``(key, result, status, error, calls, input_tokens, output_tokens)`` from one call of ``fn`` per batch.

    ``batched`` has one row per batch with an array of structs ``items``, each with the key. The
    function sees plain dictionaries. A batch is bounded, so a task holds one Arrow chunk of batches.
    """
    fields = struct_type(ddl)
    names = fields.fieldNames()
    schema = T.StructType(
        [
            T.StructField(key, T.StringType()),
            T.StructField("result", fields),
            T.StructField("ai_enrichment_status", T.StringType()),
            T.StructField("ai_enrichment_error", T.StringType()),
            *[T.StructField(name, T.IntegerType()) for name in SPENT],
        ]
    )

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for items in frame["items"]:
                rows = [dict(x) if isinstance(x, dict) else x.asDict() for x in items]
                answers, spent = answer(fn, rows, retries, delay)
                for i, (row, (result, status, error)) in enumerate(zip(rows, answers)):
                    value = {n: result.get(n) for n in names}
                    out.append((row[key], value, status, error, *(spent if i == 0 else (0, 0, 0))))
            yield pd.DataFrame(out, columns=schema.fieldNames())

    return batched.select("items").mapInPandas(call, schema)


def enrich(
    rows: DataFrame,
    cache: DataFrame,
    fn: BatchFunction,
    ddl: str,
    order: str,
    inputs: Sequence[str],
    keys: Sequence[str] = (),
    key: str = "job_hash",
    batch_rows: int = BATCH_ROWS,
    retries: int = 3,
    delay: float = 2.0,
    spent: dict[str, int] | None = None,
    behind: Iterable[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(enriched, new cache entries)``: cached results first, then one call per batch of misses.

    Batches are formed inside ``keys`` (for example the industry). Rows without a hash of their own
    share results. The answers are written before use: calls are costly and may not repeat equally. ``behind`` are
    written tables of ``rows`` that nothing else reads; they go once the rows are written here.
    """
    spark = rows.sparkSession
    names = struct_type(ddl).fieldNames()
    # the rows and what the cache has for them are computed and shuffled once, for hits, questions and answers alike
    found = cache.select(key, F.col("result").alias("_result"), F.lit(True).alias("_hit"))
    marked = materialise(rows.join(found, key, "left"), "marked")
    discard(spark, behind)
    hits = marked.filter("_hit").select(*rows.columns, F.col("_result").alias("result"))
    misses = marked.filter("_hit IS NULL").select(*rows.columns)
    asked = misses.groupBy(key).agg(
        F.min_by(F.struct(*[c for c in dict.fromkeys([order, *keys, *inputs]) if c != key]), order).alias("row")
    ).select(key, "row.*")
    with noted() as asking:
        asked = materialise(asked, "asked")
    batched = batches(asked, list(keys), order, batch_rows, F.struct(key, *[c for c in inputs if c != key]))
    made = run_batches(batched, fn, ddl, key, retries, delay)
    answers, used = materialise_observed(made, "answers", **{name: F.sum(name) for name in SPENT})
    discard(spark, asking)
    if spent is not None:
        for name, n in used.items():
            spent[name] = spent.get(name, 0) + n
    answers = answers.drop("input_tokens", "output_tokens")
    done = hits.withColumns(
        {"ai_enrichment_status": F.lit(SUCCESS), "ai_enrichment_error": F.lit(None).cast("string"),
         "from_cache": F.lit(True), "calls": F.lit(0)}
    )
    plain = misses.drop("ai_enrichment_status", "ai_enrichment_error")
    called = plain.join(answers, key).withColumn("from_cache", F.lit(False))
    both = done.unionByName(called, allowMissingColumns=True)
    entries = answers.filter(F.col("ai_enrichment_status") == SUCCESS).select(key, "result")
    return overlay(both, "result", names), entries


def save_cache(cache: DataFrame, entries: DataFrame, key: str = "job_hash") -> DataFrame:
    """The cache with new entries laid over the old ones."""
    from feedloom.operators.tables import upsert

    return upsert(cache, entries, key, protected=())


def split_failed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(succeeded, failed)``; a missing status is a success."""
    failed = F.col("ai_enrichment_status").eqNullSafe(FAILED)
    return rows.filter(~failed), rows.filter(failed)


def classifiable(rows: DataFrame) -> DataFrame:
    """Mark rows that lack an industry or its functions as failed."""
    ready = (F.coalesce(F.size("job_functions"), F.lit(0)) > 0) & (F.coalesce("industry_id", F.lit(0)) != 0)
    old = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
           for c in ("ai_enrichment_status", "ai_enrichment_error")}
    return rows.withColumns(
        {
            "ai_enrichment_status": F.when(ready, old["ai_enrichment_status"]).otherwise(FAILED),
            "ai_enrichment_error": F.when(ready, old["ai_enrichment_error"]).otherwise(MISSING_DATA),
        }
    )


def numbered_blocks(items: Column, block: Callable[[Column], Column]) -> Column:
    """One text from the items of a batch, each introduced by its number."""
    texts = F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(".\n"), block(x)))
    return F.array_join(texts, "\n\n")


def posting_block(item: Column) -> Column:
    """Title, company and cleaned description of a posting."""
    def text(name: str) -> Column:
        return F.coalesce(item[name], F.lit(""))

    return F.concat(
        F.lit("Title: "), text("title"), F.lit("\nCompany: "), text("company_name"),
        F.lit("\nDescription: "), clean_html(item["description"]),
    )


def terms_block(item: Column) -> Column:
    """Cleaned description, tags, search terms and skills of a posting."""
    return F.concat(
        F.lit("description: "), clean_html(item["description"]), F.lit("\nai_top_tags: "),
        join_terms(item["ai_top_tags"]), F.lit("\nai_search_terms: "), join_terms(item["ai_search_terms"]),
        F.lit("\nai_skills: "), join_terms(item["ai_skills"]),
    )


def prompt(
    items: Column,
    block: Callable[[Column], Column],
    introduction: str,
    request: str,
    context: Column | None = None,
    context_title: str = "",
    context_chars: int | None = None,
) -> Column:
    """The text of a batch: introduction, numbered blocks, context and request.

    ``context_chars`` cuts the context; by default it stands whole.
    """
    parts = [F.lit(introduction), numbered_blocks(items, block)]
    if context is not None:
        parts += [F.lit(context_title), context if context_chars is None else F.substring(context, 1, context_chars)]
    return F.concat_ws("\n", *parts, F.lit(request))


def seconds(run_time: datetime) -> Column:
    """The run time as seconds since 1970."""
    return F.unix_timestamp(F.lit(run_time).cast("timestamp")).cast("double")
