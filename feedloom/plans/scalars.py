"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import dates, hashing, places, similarity, text
from feedloom.plans.registry import (
    CLEAN_SQL, CLOSED_SQL, HASH_SQL, documents, hashed_postings, light_postings, pages, query, table,
)


@query(
    "fn1_clean_description",
    f"""SELECT 'd' AS kind, doc_id AS id, {CLEAN_SQL.format('text')} AS cleaned FROM documents
    UNION ALL SELECT 'p', page_id, {CLEAN_SQL.format('html')} FROM pages""",
)
def fn1(spark, sf):
    d = documents(spark, sf).select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t"))
    p = pages(spark, sf).select(F.lit("p").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("t"))
    return d.unionByName(p).select("kind", "id", text.clean_for_hash(F.col("t")).alias("cleaned"))


@query("fn2_canonical_hash", f"SELECT seq, {HASH_SQL} AS job_hash FROM postings", view=True)
def fn2(spark, sf):
    return hashed_postings(spark, sf).select("seq", "job_hash")


@query(
    "fn2b_json_hash",
    """SELECT p_partkey, to_base64(unhex(sha256(concat('{"company_name":"', p_brand, '","description":"', p_type,
    '","employment_type":', CASE WHEN p_size > 25 THEN '"FULL_TIME"' ELSE 'null' END, ',"title":"', p_name, '"}'))))
    AS json_hash FROM part""",
)
def fn2b(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("company_name"),
        F.col("p_type").alias("description"), F.when(F.col("p_size") > 25, "FULL_TIME").alias("employment_type"),
    )
    return rows.select("p_partkey", hashing.json_hash().alias("json_hash"))


FN3_SQL = (
    "lower(trim(regexp_replace(regexp_replace(text, '(?i)" + places.location_mention().replace("'", "''")
    + "', '', 'g'), '\\s+', ' ', 'g')))"
)


@query("fn3_remove_locations", f"SELECT doc_id, {FN3_SQL} AS cleaned FROM documents")
def fn3(spark, sf):
    return documents(spark, sf).select("doc_id", places.remove_location_mentions(F.col("text")).alias("cleaned"))


# the location list of the view, parsed by the oracle
PLACES_SQL = """+ parts AS (SELECT *, list_transform(string_split(locations, ','), lambda x: trim(x)) AS p FROM postings),
placed AS (SELECT *,
    CASE WHEN locations IS NULL OR len(p) NOT IN (1, 2, 3) THEN NULL ELSE p[1] END AS city,
    CASE WHEN locations IS NULL OR len(p) NOT IN (2, 3) THEN NULL ELSE p[2] END AS state,
    CASE WHEN len(p) = 3 AND lower(p[3]) NOT IN ('united states', 'usa', 'us', 'united states of america')
         THEN p[3] ELSE 'US' END AS country FROM parts)"""


@query("fn4_standard_locations", PLACES_SQL + "SELECT seq, city, state, country FROM placed", view=True)
def fn4(spark, sf):
    rows = light_postings(spark, sf).select("seq", places.locations_from_text(F.col("locations")).alias("l"))
    return rows.select("seq", F.explode("l").alias("p")).select("seq", "p.*")


@query(
    "fn5_block_key",
    "SELECT seq, concat_ws('|', lower(trim(title)), lower(trim(company_name)), lower(trim(employment_type))) AS block FROM postings",
    view=True,
)
def fn5(spark, sf):
    rows = light_postings(spark, sf)
    key = similarity.block_key(F.col("title"), F.col("company_name"), F.col("employment_type"))
    return rows.select("seq", key.alias("block"))


TURNS_SQL = """WITH said AS (SELECT *, list_distinct(list_filter(string_split(lower(trim(regexp_replace(text, '\\s+',
    ' ', 'g'))), ' '), lambda x: x <> '')) AS words FROM conversations)"""


def turn_pairs(spark, sf):
    """Each turn of a conversation with the one before it."""
    said = table(spark, sf, "conversations").withColumn("clean", F.lower(text.collapse(F.col("text"))))
    before = said.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("clean").alias("clean_before"))
    return said.join(before, ["conv_id", "turn"])


@query(
    "fn6_word_jaccard",
    TURNS_SQL + """SELECT a.conv_id, a.turn, round(CASE WHEN len(a.words) = 0 OR len(b.words) = 0 THEN 0.0 ELSE
    len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words))) END, 6) AS jaccard
    FROM said a JOIN said b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""",
)
def fn6(spark, sf):
    sets = [similarity.word_set(F.col(c)) for c in ("clean", "clean_before")]
    return turn_pairs(spark, sf).select("conv_id", "turn", F.round(similarity.jaccard(*sets), 6).alias("jaccard"))


@query("fn7_token_sort_ratio")
def fn7(spark, sf):
    left, right = (similarity.sorted_words(F.col(c)) for c in ("clean", "clean_before"))
    rows = turn_pairs(spark, sf).select("conv_id", "turn", left.alias("a"), right.alias("b"))
    return rows.select("conv_id", "turn", F.round(similarity.ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


@query(
    "fn8_clean_html",
    """SELECT page_id, trim(regexp_replace(regexp_replace(html, '<.*?>', '', 'g'), '\\s+', ' ', 'g')) AS cleaned FROM pages""",
)
def fn8(spark, sf):
    return pages(spark, sf).select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query(
    "fn9_plain_excerpt",
    """SELECT page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')), 1, 400)
    AS excerpt FROM pages""",
)
def fn9(spark, sf):
    return pages(spark, sf).select("page_id", text.plain_excerpt(F.col("html")).alias("excerpt"))


@query(
    "fn10_ellipsis",
    "SELECT doc_id, CASE WHEN length(text) > 100 THEN concat(substr(text, 1, 100), '...') ELSE text END AS shown FROM documents",
)
def fn10(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.ellipsis(F.col("text")).alias("shown"))


@query(
    "fn11_employment_type",
    """SELECT seq, CASE WHEN upper(regexp_replace(coalesce(employment_type, ''), '[^A-Za-z0-9]', '', 'g')) = 'FULLTIME'
    THEN 'FULL_TIME' ELSE 'PART_TIME' END AS employment_type FROM postings""",
    view=True,
)
def fn11(spark, sf):
    rows = light_postings(spark, sf)
    return rows.select("seq", text.employment_type(F.col("employment_type")).alias("employment_type"))


@query("fn12_status", f"SELECT seq, CASE WHEN {CLOSED_SQL} THEN 'CLOSED' ELSE 'ACTIVE' END AS status FROM postings", view=True)
def fn12(spark, sf):
    return light_postings(spark, sf).select("seq", text.posting_status(F.col("status")).alias("status"))


@query("fn13_truth", "SELECT seq, lower(is_remote) IN ('true', '1', 'yes') AS is_remote FROM postings", view=True)
def fn13(spark, sf):
    return light_postings(spark, sf).select("seq", text.truth(F.col("is_remote")).alias("is_remote"))


@query(
    "fn14_number",
    "SELECT seq, TRY_CAST(salary_min AS DOUBLE) AS salary, coalesce(TRY_CAST(salary_min AS DOUBLE), 0.0) AS salary_or_zero FROM postings",
    view=True,
)
def fn14(spark, sf):
    salary = F.col("salary_min")
    return light_postings(spark, sf).select(
        "seq", text.number(salary).alias("salary"), text.number(salary, 0.0).alias("salary_or_zero")
    )


@query(
    "fn15_unescape",
    """SELECT page_id, regexp_replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'),
    '&middot;', '·'), '&amp;?', '&', 'g') AS plain FROM pages""",
)
def fn15(spark, sf):
    return pages(spark, sf).select("page_id", text.unescape_entities(F.col("html")).alias("plain"))


@query(
    "fn16_unescape_web_address",
    """SELECT page_id, url AS address, html AS other FROM pages""",
)
def fn16(spark, sf):
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    return pages(spark, sf).select(
        "page_id", text.unescape_web_address(escaped).alias("address"),
        text.unescape_web_address(F.col("html")).alias("other"),
    )


@query(
    "fn17_xml_repair",
    """WITH kept AS (SELECT page_id, regexp_replace(html, '&(amp|lt|gt|quot|apos);', concat(chr(1), '\\1;'), 'g') AS k FROM pages)
    SELECT page_id, replace(replace(k, '&', '&amp;'), chr(1), '&') AS repaired FROM kept""",
)
def fn17(spark, sf):
    return pages(spark, sf).select("page_id", text.repair_xml(F.col("html")).alias("repaired"))


# order dates written in several layouts, by priority
WRITTEN = """CASE o_orderpriority
    WHEN '1-URGENT' THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    WHEN '2-HIGH' THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    WHEN '3-MEDIUM' THEN date_format(o_orderdate, "E, dd MMM yyyy HH:mm:ss 'GMT'")
    WHEN '4-NOT SPECIFIED' THEN date_format(o_orderdate, 'M/d/yyyy')
    ELSE concat('on ', o_orderstatus) END"""


def written_dates(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", F.expr(WRITTEN).alias("written"))


@query(
    "fn18_lenient_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""",
)
def fn18(spark, sf):
    parsed = dates.naive_timestamp(F.col("written"))
    return written_dates(spark, sf).select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "fn19_naive_utc",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN
    strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS utc FROM orders""",
)
def fn19(spark, sf):
    utc = dates.naive_utc(dates.instant(F.col("written")))
    return written_dates(spark, sf).select("o_orderkey", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query(
    "fn20_warehouse_timestamp",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN
    strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') END AS stamp FROM orders""",
)
def fn20(spark, sf):
    return written_dates(spark, sf).select("o_orderkey", dates.warehouse_timestamp(F.col("written")).alias("stamp"))


@query(
    "fn21_epoch_millis",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '2-HIGH' THEN epoch_ms(o_orderdate - INTERVAL 2 HOUR)
    ELSE epoch_ms(o_orderdate) END AS millis, CAST(floor(o_totalprice) * 1000 AS BIGINT) AS from_number,
    CASE WHEN epoch_ms(o_orderdate) > 1000000000000 THEN epoch_ms(o_orderdate) ELSE epoch_ms(o_orderdate) * 1000 END AS from_large
    FROM orders""",
)
def fn21(spark, sf):
    rows = written_dates(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return rows.select(
        "o_orderkey",
        dates.epoch_millis(F.col("written")).alias("millis"),
        dates.epoch_number_to_millis(F.floor("o_totalprice")).alias("from_number"),
        dates.epoch_number_to_millis(millis).alias("from_large"),
    )


@query(
    "fn22_iso_validity",
    "SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_iso FROM orders",
)
def fn22(spark, sf):
    return written_dates(spark, sf).select("o_orderkey", dates.is_iso(F.col("written")).alias("is_iso"))


@query(
    "fn23_location_string",
    PLACES_SQL + "SELECT seq, concat_ws(' ', city, state, country) AS location_string FROM placed",
    view=True,
)
def fn23(spark, sf):
    rows = light_postings(spark, sf).select("seq", places.locations_from_text(F.col("locations")).alias("l"))
    return rows.select("seq", places.location_string(F.col("l")).alias("location_string"))


FEED_PLACES_SQL = PLACES_SQL + """, lists AS (SELECT company_name, feed_id,
    count(DISTINCT concat_ws('|', coalesce(city, ' '), coalesce(state, ' '), country)) AS n,
    count(DISTINCT nullif(state, '')) AS states, min(nullif(state, '')) AS a_state,
    min(struct_pack(c := coalesce(city, ''), s := coalesce(state, ''), k := country)) AS first FROM placed GROUP BY ALL)
SELECT company_name, feed_id, CASE
    WHEN n = 1 THEN concat_ws(', ', nullif(first.c, ''), nullif(first.s, ''), first.k)
    WHEN states = 1 THEN concat(a_state, ', ', first.k) ELSE first.k END AS geo_query FROM lists"""


@query("fn24_geo_query", FEED_PLACES_SQL, view=True)
def fn24(spark, sf):
    """The lookup key of all places of a company in a feed."""
    rows = light_postings(spark, sf).select(
        "company_name", "feed_id", F.explode(places.locations_from_text(F.col("locations"))).alias("l")
    ).distinct()
    lists = rows.groupBy("company_name", "feed_id").agg(F.array_sort(F.collect_list("l")).alias("l"))
    return lists.select("company_name", "feed_id", places.geo_query(F.col("l")).alias("geo_query"))


@query(
    "fn25_wkt_point",
    """SELECT n_nationkey, concat('POINT(', CAST(CAST(n_nationkey * 10 - 120 AS DOUBLE) AS VARCHAR), ' ',
    CAST(CAST(n_regionkey * 15 - 30 AS DOUBLE) AS VARCHAR), ')') AS wkt FROM nation""",
)
def fn25(spark, sf):
    geo = F.struct(
        (F.col("n_regionkey") * 15 - 30).cast("double").alias("lat"),
        (F.col("n_nationkey") * 10 - 120).cast("double").alias("lng"),
    )
    return table(spark, sf, "nation").withColumn("geo", geo).select("n_nationkey", places.wkt_point(F.col("geo")).alias("wkt"))


@query(
    "fn26_json_text",
    """SELECT event_id, concat('{"event_type":"', event_type, '","value":', CAST(value AS VARCHAR), '}') AS as_json,
    CAST(props->>'k' AS INT) AS k FROM events""",
)
def fn26(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.to_json(F.struct("event_type", "value")).alias("as_json"),
        F.from_json("props", "k int")["k"].alias("k"),
    )


@query(
    "fn31_fresh_entries",
    """SELECT event_id, epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(ts) < 604800 AS fresh FROM events""",
)
def fn31(spark, sf):
    from feedloom.operators.enrich import is_fresh

    now = F.unix_timestamp(F.lit("2024-01-20 00:00:00")).cast("double")
    saved = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf, "events").select("event_id", is_fresh(saved, now).alias("fresh"))


@query(
    "fn32_join_terms",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))), ', ') AS terms FROM documents""",
)
def fn32(spark, sf):
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))))
    return documents(spark, sf).select("doc_id", text.join_terms(found).alias("terms"))


