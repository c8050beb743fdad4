"""Queries of the enrichment, the lookups and the routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import places
from feedloom.functions.hashing import canonical_hash
from feedloom.operators import enrich, ordinals, routing, taxonomy
from feedloom.plans import stand_ins
from feedloom.plans.registry import hashed_postings, light_postings, postings, query, select_sql, table
from feedloom.plans.scalars import PLACES_SQL


def cached(spark, sf):
    """Labelled postings as cached results, by hash; the highest row of a hash counts."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("seq"), "quality", "toxic")
    rows = postings(spark, sf).join(labels, "seq").select("seq", canonical_hash().alias("job_hash"), "quality", "toxic")
    last = ordinals.last_per_key(rows, "job_hash", "seq")
    return last.select("job_hash", F.struct((F.col("quality") * 100.0).alias("confidence_score"), F.col("toxic").alias("sector_id")).alias("result"))


CACHE_SQL = """+ cache AS (SELECT job_hash, arg_max(quality, seq) * 100.0 AS q, arg_max(toxic, seq) AS t FROM hashed JOIN labels ON seq = doc_id GROUP BY job_hash)"""


@query("jn5_cache_lookup", CACHE_SQL + " SELECT seq, CASE WHEN c.job_hash IS NULL THEN 'miss' ELSE 'hit' END AS found, CAST(c.q AS DOUBLE) AS score FROM hashed LEFT JOIN cache c USING (job_hash)", view=True)
def jn5(spark, sf):
    hits, misses = enrich.cache_hits(hashed_postings(spark, sf).select("seq", "job_hash"), cached(spark, sf))
    return hits.select("seq", F.lit("hit").alias("found"), F.col("result.confidence_score").alias("score")).unionByName(
        misses.select("seq", F.lit("miss").alias("found"), F.lit(None).cast("double").alias("score"))
    )


@query("fn30_overlay", CACHE_SQL + " SELECT seq, coalesce(CAST(c.q AS DOUBLE), ai_confidence_score) AS ai_confidence_score, c.t AS sector_id FROM hashed LEFT JOIN cache c USING (job_hash)", view=True)
def fn30(spark, sf):
    results = cached(spark, sf).select("job_hash", F.struct(
        F.col("result.confidence_score").alias("ai_confidence_score"), F.col("result.sector_id").alias("sector_id")
    ).alias("result"))
    rows = hashed_postings(spark, sf).select("seq", "job_hash", "ai_confidence_score").join(results, "job_hash", "left")
    return enrich.overlay(rows, "result", ["ai_confidence_score", "sector_id"]).select("seq", "ai_confidence_score", "sector_id")


@query(
    "sk14_save_cache",
    CACHE_SQL + """, fresh AS (SELECT job_hash, max(ai_confidence_score) AS s FROM hashed GROUP BY job_hash HAVING max(ai_confidence_score) IS NOT NULL)
    SELECT job_hash, coalesce(s, CAST(q AS DOUBLE)) AS score FROM cache FULL JOIN fresh USING (job_hash)""",
    view=True,
)
def sk14(spark, sf):
    old = cached(spark, sf).select("job_hash", F.col("result.confidence_score").alias("result"))
    new = hashed_postings(spark, sf).groupBy("job_hash").agg(F.max("ai_confidence_score").alias("result")).filter("result IS NOT NULL")
    return enrich.save_cache(old, new).withColumnRenamed("result", "score")


def functions_of_industries(spark, sf):
    """A nested taxonomy: nations are functions, regions are sectors; industries share functions."""
    nested = select_sql(
        table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")),
        """1 + n_nationkey % 8 AS industry_id, n_nationkey, named_struct('id', n_nationkey, 'name', n_name, 'discipline_detail',
        named_struct('sub_industry_detail', named_struct('industry_detail', named_struct('id', 1 + n_nationkey % 8,
        'name', concat('industry ', 1 + n_nationkey % 8), 'industry_group_detail', named_struct('id', n_regionkey,
        'name', concat('group ', n_regionkey), 'sector_detail', named_struct('id', n_regionkey, 'name', r_name)))))) AS f""",
    )
    known = nested.filter("industry_id < 7")
    pairs = F.array_sort(F.collect_list(F.struct("n_nationkey", "f")))
    return known.groupBy("industry_id").agg(F.transform(pairs, lambda p: p["f"]).alias("job_functions"))


@query(
    "jn6_industry_functions",
    """+ n AS (SELECT 1 + n_nationkey % 8 AS industry_id, count(*) AS k, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation
    WHERE 1 + n_nationkey % 8 < 7 GROUP BY ALL)
    SELECT seq, coalesce(k, 0) AS functions, coalesce(names, '') AS names FROM postings LEFT JOIN n USING (industry_id)""",
    view=True,
)
def jn6(spark, sf):
    rows = taxonomy.attach_functions(light_postings(spark, sf).select("seq", "industry_id"), functions_of_industries(spark, sf))
    names = F.array_join(F.transform("job_functions", lambda f: f["name"]), ",")
    return rows.select("seq", F.size("job_functions").cast("long").alias("functions"), names.alias("names"))


@query(
    "jn7_taxonomy_names",
    """SELECT c_custkey, coalesce(r_name, '') AS sector, coalesce('group ' || n_regionkey, '') AS industry_group,
    coalesce('industry ' || (1 + n_nationkey % 8), '') AS industry FROM customer
    LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE 1 + n_nationkey % 8 < 7) ON c_nationkey = n_nationkey""",
)
def jn7(spark, sf):
    names = taxonomy.function_names(functions_of_industries(spark, sf))
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("job_function_id"))
    return taxonomy.attach_names(rows, names).select("c_custkey", "sector", "industry_group", "industry")


@query(
    "ag7_ids_to_fetch",
    """SELECT DISTINCT industry_id FROM postings WHERE industry_id NOT IN (SELECT 1 + n_nationkey % 8 FROM nation WHERE n_nationkey < 3)""",
    view=True,
)
def ag7(spark, sf):
    cache = table(spark, sf, "nation").select(
        (1 + F.col("n_nationkey") % 8).alias("industry_id"),
        F.when(F.col("n_nationkey") < 3, 1_000_000.0).otherwise(0.0).alias("timestamp"),
    )
    return enrich.ids_to_fetch(light_postings(spark, sf), cache, "industry_id", F.lit(1_000_100.0))


@query(
    "ag8_classification_batches",
    """SELECT industry_id, CAST((rn - 1) // 10 + 1 AS BIGINT) AS batch_no, count(*) AS batch_rows, min(seq) AS first, max(seq) AS last FROM (
    SELECT seq, industry_id, row_number() OVER (PARTITION BY industry_id ORDER BY seq) AS rn FROM postings WHERE industry_id < 7) GROUP BY ALL
    UNION ALL SELECT industry_id, CAST(NULL AS BIGINT), count(*), min(seq), max(seq) FROM postings WHERE industry_id >= 7 GROUP BY industry_id""",
    view=True,
)
def ag8(spark, sf):
    """Batches inside each industry; postings whose industry has no functions fail."""
    rows = taxonomy.attach_functions(light_postings(spark, sf).select("seq", "industry_id"), functions_of_industries(spark, sf))
    ready, failed = enrich.split_failed(enrich.classifiable(rows))
    batched = ordinals.batches(ready.select("seq", "industry_id"), ["industry_id"], "seq", 10, F.col("seq"))
    good = batched.select("industry_id", "batch_no", "batch_rows", F.array_min("items").alias("first"), F.array_max("items").alias("last"))
    bad = failed.groupBy("industry_id").agg(F.count(F.lit(1)).alias("batch_rows"), F.min("seq").alias("first"), F.max("seq").alias("last"))
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "ag11_batch_assembly",
    """SELECT feed_id, CAST((rn - 1) // 10 + 1 AS BIGINT) AS batch_no, count(*) AS batch_rows, string_agg(external_job_id, ',' ORDER BY seq) AS ids FROM (
    SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY seq) AS rn FROM postings) GROUP BY ALL""",
    view=True,
)
def ag11(spark, sf):
    rows = light_postings(spark, sf).select("feed_id", "seq", "external_job_id")
    out = ordinals.batches(rows, ["feed_id"], "seq", 10, F.col("external_job_id"))
    return out.select("feed_id", "batch_no", "batch_rows", F.array_join("items", ",").alias("ids"))


NUMBERED_TURNS = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)"""


@query(
    "jn12_positional_zip",
    NUMBERED_TURNS + """, t AS (SELECT conv_id, turn, text, CAST((rn - 1) // 2 + 1 AS BIGINT) AS batch_no, CAST((rn - 1) % 2 AS INT) AS position FROM r),
    b AS (SELECT conv_id, batch_no, count(*) = count(*) FILTER (WHERE length(text) > 200) AS fits FROM t GROUP BY ALL)
    SELECT conv_id, batch_no, position, turn, CASE WHEN fits THEN 'success' ELSE 'failed' END AS ai_enrichment_status,
    CASE WHEN fits THEN length(text) END AS result FROM t JOIN b USING (conv_id, batch_no)""",
)
def jn12(spark, sf):
    """Batches of two turns; only turns of some length get a result, so other batches do not line up."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("chars"))
    batched = ordinals.batches(rows, ["conv_id"], "turn", 2, F.struct("turn", "chars"))
    kept = F.filter("items", lambda s: s["chars"] > 200)
    ready = batched.select(
        "conv_id", "batch_no", F.transform("items", lambda s: s["turn"]).alias("items"),
        F.transform(kept, lambda s: s["chars"]).alias("results"),
    )
    return enrich.zip_results(ready).select(
        "conv_id", "batch_no", "position", F.col("item").alias("turn"), "ai_enrichment_status", "result"
    )


@query(
    "fn29_parse_response",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS rn FROM orders),
    k AS (SELECT *, CAST(rn // 10 + 1 AS BIGINT) AS batch_no FROM n)
    SELECT o_orderpriority, batch_no, CAST(row_number() OVER (PARTITION BY o_orderpriority, batch_no ORDER BY o_orderkey) - 1 AS INT) AS pos,
    CAST(o_orderkey AS INT) AS job_function_id, o_orderstatus AS reasoning FROM k WHERE o_orderstatus <> 'F'""",
)
def fn29(spark, sf):
    """Responses for batches of ten orders, some entries being plain texts instead of objects."""
    entry = F.when(
        F.col("o_orderstatus") != "F",
        F.to_json(F.struct(F.col("o_orderkey").alias("job_function_id"), F.col("o_orderstatus").alias("reasoning"))),
    ).otherwise(F.lit('"none"'))
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", entry.alias("e"))
    batched = ordinals.batches(rows, ["o_orderpriority"], "o_orderkey", 10, F.col("e"))
    response = F.concat(F.lit('{"selections": ['), F.array_join("items", ", "), F.lit("]}"))
    parsed = enrich.parse_response(response, enrich.SELECTION, "selections")
    return batched.select("o_orderpriority", "batch_no", F.posexplode(parsed).alias("pos", "r")).select(
        "o_orderpriority", "batch_no", "pos", "r.*"
    )


CLEAN_TEXT = "trim(regexp_replace(regexp_replace(text, '<.*?>', '', 'g'), '\\s+', ' ', 'g'))"


@query(
    "fn28_prompt",
    f"""{NUMBERED_TURNS}, t AS (SELECT conv_id, turn, role, {CLEAN_TEXT} AS t, CAST((rn - 1) // 10 + 1 AS BIGINT) AS batch_no, (rn - 1) % 10 + 1 AS k FROM r)
    SELECT conv_id, batch_no, concat('--- ITEMS ---', chr(10), string_agg(concat(k, '.', chr(10), 'Title: ', role, chr(10), 'Company: c', conv_id, chr(10), 'Description: ', t),
    chr(10) || chr(10) ORDER BY turn), chr(10), '--- CONTEXT ---', chr(10), 'ids: ', conv_id, chr(10), 'Answer in JSON.') AS prompt FROM t GROUP BY conv_id, batch_no""",
)
def fn28(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("title"), F.concat(F.lit("c"), "conv_id").alias("company_name"), F.col("text").alias("description")
    )
    batched = ordinals.batches(rows, ["conv_id"], "turn", 10, F.struct("title", "company_name", "description"))
    context = F.concat(F.lit("ids: "), F.col("conv_id"))
    text = enrich.prompt(F.col("items"), enrich.posting_block, "--- ITEMS ---", "Answer in JSON.", context, "--- CONTEXT ---")
    return batched.select("conv_id", "batch_no", text.alias("prompt"))


def marked_lengths(rows: list[dict]) -> list[dict]:
    """A batch function that fails on long batches, so that they are halved."""
    if len(rows) > 4:
        raise enrich.TooLarge
    return [{"reasoning": f"<{r['title']}>", "job_function_id": len(r["title"])} for r in rows]


@query(
    "ud2_batch_function",
    """SELECT seq, concat('<', title, '>') AS reasoning, CAST(length(title) AS INT) AS job_function_id, 'success' AS ai_enrichment_status FROM postings""",
    view=True,
)
def ud2(spark, sf):
    """A user function per batch of ten; batches are halved until the function takes them."""
    rows = light_postings(spark, sf).select(F.col("seq").cast("string").alias("job_hash"), "seq", F.coalesce("title", F.lit("")).alias("title"), "feed_id")
    batched = ordinals.batches(rows, ["feed_id"], "seq", 10, F.struct("job_hash", "title"))
    out = enrich.run_batches(batched, marked_lengths, enrich.SELECTION, delay=0.0)
    return out.select(F.col("job_hash").cast("long").alias("seq"), "result.reasoning", "result.job_function_id", "ai_enrichment_status")


def failing(rows: list[dict]) -> list[dict]:
    if any(r["feed_id"] == 2 for r in rows):
        raise ValueError("no answer")
    return [{"searchable_text": r["job_hash"]} for r in rows][: len(rows) - (rows[0]["feed_id"] == 3)]


@query(
    "ud4_failed_batches",
    """SELECT feed_id, CASE WHEN feed_id IN (2, 3) THEN 'failed' ELSE 'success' END AS ai_enrichment_status,
    CASE feed_id WHEN 2 THEN 'Batch processing failed with exception: no answer' WHEN 3 THEN 'AI response length mismatch' END AS ai_enrichment_error,
    count(*) AS n, CAST(sum(CASE WHEN rn % 10 = 1 THEN CASE feed_id WHEN 2 THEN 3 ELSE 1 END ELSE 0 END) AS BIGINT) AS calls
    FROM (SELECT feed_id, row_number() OVER (PARTITION BY feed_id ORDER BY seq) AS rn FROM postings) GROUP BY ALL""",
    view=True,
)
def ud4(spark, sf):
    """One feed always fails and is tried three times, one answers too short; both become failed rows."""
    rows = light_postings(spark, sf).select(F.concat_ws("-", "feed_id", "seq").alias("job_hash"), "seq", "feed_id")
    batched = ordinals.batches(rows, ["feed_id"], "seq", 10, F.struct("job_hash", "feed_id"))
    out = enrich.run_batches(batched, failing, enrich.SEARCHABLE, delay=0.0)
    feed = F.split("job_hash", "-").getItem(0).cast("int")
    return out.groupBy(feed.alias("feed_id"), "ai_enrichment_status", "ai_enrichment_error").agg(
        F.count(F.lit(1)).alias("n"), F.sum("calls").alias("calls")
    )


@query("ud5_initial_enrichment")
def ud5(spark, sf):
    """Cached results first, rule-based answers for the rest."""
    rows = hashed_postings(spark, sf).select("seq", "job_hash", "title", "company_name", "description")
    empty = no_cache(spark, enrich.ATTRIBUTES)
    known = cached(spark, sf).select("job_hash", F.to_json("result").alias("j"))
    cache = empty.unionByName(known.select("job_hash", F.from_json("j", enrich.struct_type(enrich.ATTRIBUTES)).alias("result")))
    out, _ = enrich.enrich(rows, cache, stand_ins.keyword_rules, enrich.ATTRIBUTES, "seq", ["title", "description"], delay=0.0)
    return out.select("seq", "ai_title", "industry_id", "confidence_score", "from_cache", "ai_enrichment_status")


def no_cache(spark, ddl: str):
    return spark.createDataFrame([], f"job_hash string, result {enrich.struct_type(ddl).simpleString()}")


@query(
    "ud5_job_functions",
    """+ n AS (SELECT 1 + n_nationkey % 8 AS industry_id, min(n_nationkey) AS f FROM nation WHERE 1 + n_nationkey % 8 < 7 GROUP BY ALL)
    SELECT seq, f AS job_function_id, CASE WHEN f IS NULL THEN 'failed' ELSE 'success' END AS ai_enrichment_status,
    CASE WHEN f IS NULL THEN 'Missing data for function classification' END AS ai_enrichment_error FROM postings LEFT JOIN n USING (industry_id)""",
    view=True,
)
def ud5_functions(spark, sf):
    """A function per posting, asked in batches of one industry; industries without functions fail."""
    rows = light_postings(spark, sf).select("seq", F.col("seq").cast("string").alias("job_hash"), "industry_id")
    listed = enrich.classifiable(taxonomy.attach_functions(rows, functions_of_industries(spark, sf)))
    ready, failed = enrich.split_failed(listed)
    ready = ready.withColumn("function_ids", F.transform("job_functions", lambda f: f["id"]))
    out, _ = enrich.enrich(
        ready, no_cache(spark, enrich.SELECTION), stand_ins.first_function, enrich.SELECTION, "seq", ["function_ids"], ["industry_id"], delay=0.0
    )
    columns = ["seq", "job_function_id", "ai_enrichment_status", "ai_enrichment_error"]
    return out.select(*columns).unionByName(failed.withColumn("job_function_id", F.lit(None).cast("int")).select(*columns))


@query(
    "ud5_searchable_text",
    "SELECT seq, concat(company_name, ', ', employment_type) AS searchable_text, false AS from_cache FROM postings",
    view=True,
)
def ud5_searchable(spark, sf):
    """The distinct terms of each posting as one text."""
    rows = light_postings(spark, sf).select(
        "seq", F.col("seq").cast("string").alias("job_hash"), F.array("company_name").alias("ai_top_tags"),
        F.array("employment_type").alias("ai_search_terms"), F.array("company_name").alias("ai_skills"),
    )
    terms = ["ai_top_tags", "ai_search_terms", "ai_skills"]
    out, _ = enrich.enrich(rows, no_cache(spark, enrich.SEARCHABLE), stand_ins.joined_terms, enrich.SEARCHABLE, "seq", terms, delay=0.0)
    return out.select("seq", "searchable_text", "from_cache")


GAZETTEER_SQL = """, g AS (SELECT 'Boston, MA, US' AS query, 42.36 AS lat, -71.06 AS lng UNION ALL SELECT 'Paris, IDF, France', 48.86, 2.35
    UNION ALL SELECT 'Remote, US', NULL, NULL)"""
GEO_KEY_SQL = "concat_ws(', ', nullif(city, ''), nullif(state, ''), country)"


def gazetteer(spark):
    """A few known places; the postings are what grows."""
    rows = [("Boston, MA, US", 42.36, -71.06), ("Paris, IDF, France", 48.86, 2.35), ("Remote, US", None, None)]
    return spark.createDataFrame(rows, "query string, lat double, lng double")


@query("jn14_coordinates", PLACES_SQL + GAZETTEER_SQL + f" SELECT seq, CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng FROM placed LEFT JOIN g ON g.query = {GEO_KEY_SQL}", view=True)
def jn14(spark, sf):
    rows = light_postings(spark, sf).select("seq", places.locations_from_text(F.col("locations")).alias("locations"))
    return taxonomy.attach_coordinates(rows, gazetteer(spark)).select("seq", "_geo.lat", "_geo.lng")


@query("jn14_unknown_places", PLACES_SQL + GAZETTEER_SQL + f" SELECT DISTINCT {GEO_KEY_SQL} AS query FROM placed WHERE {GEO_KEY_SQL} NOT IN (SELECT query FROM g)", view=True)
def jn14_unknown(spark, sf):
    rows = light_postings(spark, sf).select(places.locations_from_text(F.col("locations")).alias("locations"))
    return taxonomy.unknown_places(rows, gazetteer(spark))


ROUTE_SQL = """CASE WHEN ai_confidence_score IS NULL THEN 'MANUAL_REVIEW' WHEN ai_confidence_score / 100 < 0.5 THEN 'REJECTED'
    WHEN ai_confidence_score / 100 < 0.86 THEN 'MANUAL_REVIEW' ELSE 'ACTIVE' END"""


@query("pf12_confidence_route", f"SELECT seq, {ROUTE_SQL} AS status FROM postings", view=True)
def pf12(spark, sf):
    return routing.with_route(light_postings(spark, sf).select("seq", "ai_confidence_score")).select("seq", "status")


@query("pf12b_two_way_route", "SELECT seq, CASE WHEN ai_confidence_score / 100 >= 0.86 THEN 'approve' ELSE 'review' END AS decision FROM postings", view=True)
def pf12b(spark, sf):
    share = F.col("ai_confidence_score") / 100
    return light_postings(spark, sf).select("seq", routing.approve_or_review(share).alias("decision"))


@query(
    "pf13_split_failed",
    """SELECT CASE WHEN is_remote = 'false' THEN 'failed' ELSE 'succeeded' END AS side, count(*) AS n FROM postings GROUP BY ALL""",
    view=True,
)
def pf13(spark, sf):
    state = F.expr("CASE is_remote WHEN 'false' THEN 'failed' WHEN 'Yes' THEN 'success' END")
    good, bad = enrich.split_failed(light_postings(spark, sf).select(state.alias("ai_enrichment_status")))
    return good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("succeeded").alias("side"), "n").unionByName(
        bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("failed").alias("side"), "n")
    )


@query("pf14_bypass", f"SELECT seq, CASE WHEN feed_id = 4 THEN 'ACTIVE' ELSE {ROUTE_SQL} END AS status FROM postings", view=True)
def pf14(spark, sf):
    rows = light_postings(spark, sf).select("seq", "feed_id", "ai_confidence_score")
    return routing.with_route(rows, F.col("feed_id") == 4).select("seq", "status")


