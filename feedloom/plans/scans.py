"""Queries of the scans, the mapping and the validation. Feeds are first landed by Spark from the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.hashing import base64_sha256, canonical_hash
from feedloom.operators import audit, mapping, ordinals, tables, validate
from feedloom.plans.registry import (
    CLOSED_SQL, HASH_SQL, hashed_postings, light_postings, postings, query, select_sql, table,
)
from feedloom.session import materialise, scratch_path
from feedloom.sources import feeds, files

MAPPINGS = {
    "referencenumber": "external_job_id", "company": "company_name", "title": "title", "body": "description",
    "description": "description", "url": "application_url", "city": "city", "state": "state", "country": "country",
    "location": "locations", "jobtype": "employment_type", "status": "status", "salary_min": "salary_min",
}


def tag(name: str, value: Column) -> Column:
    """One element; a null value gives an empty text."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")), F.lit(""))


def land_feed(spark, sf, compression: str = "none") -> str:
    """Write the postings as one XML feed and return its folder."""
    rows = postings(spark, sf)
    cdata = F.concat(F.lit("<![CDATA["), F.col("description"), F.lit("]]>"))
    address = F.concat(F.lit("https://jobs.example.com/apply?id="), F.col("seq"), F.lit("&ref=feed&amp;x=1"))
    job = F.concat(
        F.lit("<job>"),
        tag("ReferenceNumber", F.col("external_job_id")),
        tag("Company", F.concat(F.lit("  R&D "), F.col("company_name"))),
        tag("description", cdata),
        tag("url", address),
        tag("location", F.col("locations")),
        tag("jobtype", F.col("employment_type")),
        tag("status", F.col("status")),
        tag("salary_min", F.col("salary_min")),
        F.lit("</job>"),
    )
    path = scratch_path(spark, "feed")
    rows.select(job.alias("value")).write.option("compression", compression).text(path)
    return path


TRIMMED = "regexp_replace(description, '^\\s+|\\s+$', '', 'g')"


@query(
    "sc1_xml_feed",
    f"""SELECT external_job_id, concat('R&D ', company_name) AS company_name, replace({TRIMMED}, '&', '&amp;') AS description,
    concat('https://jobs.example.com/apply?id=', seq, '&ref=feed&x=1') AS application_url, locations, status FROM postings""",
    view=True,
)
def sc1(spark, sf):
    rows = feeds.read_feed(spark, land_feed(spark, sf), MAPPINGS)
    return rows.select("external_job_id", "company_name", "description", "application_url", "locations", "status")


@query("sc2_gzip_feed", "SELECT count(*) AS total_in_feed, true AS has_size FROM postings", view=True)
def sc2(spark, sf):
    fragments = feeds.scan_fragments(spark, land_feed(spark, sf, "gzip"))
    return feeds.feed_sizes(fragments).agg(
        F.sum("total_in_feed").alias("total_in_feed"), (F.min("feed_file_size_bytes") > 0).alias("has_size")
    )


MIXED = """CASE seq % 5 WHEN 0 THEN concat('<job id="', external_job_id, '"><title>a</title><status/></job>')
    WHEN 1 THEN concat('<job><ReferenceNumber>', external_job_id, '</job>')
    WHEN 2 THEN concat('<job><ReferenceNumber>', external_job_id, '</ReferenceNumber><status><![CDATA[ a < b ]]></status></job>')
    WHEN 3 THEN concat('<job\t\nid="', external_job_id, '" kind="b"></job>')
    ELSE concat('<job><ReferenceNumber>', external_job_id, '</ReferenceNumber><job_kind>c</job_kind></job>') END"""


def land_mixed_feed(spark, sf):
    """Postings of five kinds in feed order: attributes, broken, verbatim text, attributes alone, a tag like the start tag."""
    path = scratch_path(spark, "mixed")
    rows = select_sql(light_postings(spark, sf).select("seq", "external_job_id"), f"seq, {MIXED} AS value")
    rows.repartitionByRange(4, "seq").sortWithinPartitions("seq").select("value").write.option("lineSep", "\n").text(path)
    return path


@query(
    "sc1_mixed_feed",
    """SELECT row_number() OVER (ORDER BY seq) AS place, external_job_id, CASE seq % 5 WHEN 2 THEN 'a < b' END AS status FROM postings WHERE seq % 5 <> 1""",
    view=True,
)
def sc1_mixed(spark, sf):
    """Postings with and without attributes, numbered in feed order; the broken ones are out."""
    mappings = {"ReferenceNumber": "external_job_id", "id": "external_job_id", "status": "status"}
    rows = materialise(feeds.read_feed(spark, land_mixed_feed(spark, sf), mappings, attributes=True), "mixed")
    return feeds.numbered(rows, "place").select("place", "external_job_id", "status")


@query(
    "sc2_accepted_fragments",
    """SELECT 'all' AS kind, count(*) FILTER (WHERE seq % 5 <> 1) AS total_in_feed FROM postings
    UNION ALL SELECT 'bare', count(*) FILTER (WHERE seq % 5 IN (2, 4)) FROM postings""",
    view=True,
)
def sc2_accepted(spark, sf):
    path = land_mixed_feed(spark, sf)
    every = feeds.feed_sizes(feeds.scan_fragments(spark, path, attributes=True)).withColumn("kind", F.lit("all"))
    bare = feeds.feed_sizes(feeds.scan_fragments(spark, path)).withColumn("kind", F.lit("bare"))
    return every.unionByName(bare).groupBy("kind").agg(F.sum("total_in_feed").alias("total_in_feed"))


@query(
    "sc3_mixed_tags",
    """WITH t AS (SELECT CASE doc_id % 5 WHEN 0 THEN ['_id', 'title', 'status'] WHEN 2 THEN ['ReferenceNumber', 'status'] WHEN 3 THEN ['_id', '_kind']
    WHEN 4 THEN ['ReferenceNumber', 'job_kind'] ELSE CAST([] AS VARCHAR[]) END AS tags, doc_id FROM documents), u AS (SELECT unnest(tags) AS tag, doc_id FROM t)
    SELECT tag, count(*) AS rows, count(*) FILTER (WHERE NOT (tag = 'status' AND doc_id % 5 = 0)) AS filled,
    CASE WHEN tag IN ('_id', 'ReferenceNumber') THEN count(*) ELSE 1 END AS distinct_values FROM u GROUP BY tag""",
)
def sc3_mixed(spark, sf):
    """The profile of the same feed: broken postings are not in it, attributes and empty elements are."""
    return audit.tag_profile(feeds.raw_tags(feeds.scan_fragments(spark, land_mixed_feed(spark, sf), attributes=True)))


PROFILE_SQL = f"""+ tags AS (
    SELECT 'ReferenceNumber' AS tag, external_job_id AS v FROM postings
    UNION ALL SELECT 'Company', concat('R&D ', company_name) FROM postings
    UNION ALL SELECT 'description', {TRIMMED} FROM postings
    UNION ALL SELECT 'url', concat('https://jobs.example.com/apply?id=', seq) FROM postings
    UNION ALL SELECT 'location', locations FROM postings WHERE locations IS NOT NULL
    UNION ALL SELECT 'jobtype', employment_type FROM postings
    UNION ALL SELECT 'status', status FROM postings WHERE status IS NOT NULL
    UNION ALL SELECT 'salary_min', salary_min FROM postings WHERE salary_min IS NOT NULL)
SELECT tag, count(*) AS rows, count(*) FILTER (WHERE v <> '') AS filled,
    count(DISTINCT v) FILTER (WHERE v <> '') AS distinct_values"""


@query("sc3_raw_tags", PROFILE_SQL + " FROM tags GROUP BY tag", view=True)
def sc3(spark, sf):
    return audit.tag_profile(feeds.raw_tags(feeds.scan_fragments(spark, land_feed(spark, sf))))


@query(
    "ag10_feed_profile",
    PROFILE_SQL + """, CASE tag WHEN 'ReferenceNumber' THEN 'external_job_id' WHEN 'Company' THEN 'company_name'
    WHEN 'description' THEN 'description' WHEN 'url' THEN 'application_url' WHEN 'location' THEN 'locations'
    WHEN 'jobtype' THEN 'employment_type' ELSE tag END AS target, true AS is_mapped FROM tags GROUP BY tag""",
    view=True,
)
def ag10(spark, sf):
    return audit.tag_profile(feeds.raw_tags(feeds.scan_fragments(spark, land_feed(spark, sf))), MAPPINGS)


ORDER_DDL = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"
ORDER_SQL = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders"


@query("sc5_csv_records", ORDER_SQL)
def sc5_csv(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "orders").selectExpr(*[c.split()[0] for c in ORDER_DDL.split(", ")]).write.option(
        "header", True
    ).csv(path)
    return files.read_records(spark, path, "csv", ORDER_DDL)


@query("sc5_json_records", ORDER_SQL)
def sc5_json(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "orders").selectExpr(*[c.split()[0] for c in ORDER_DDL.split(", ")]).write.json(path)
    return files.read_records(spark, path, "jsonl", ORDER_DDL)


@query(
    "sc6_file_kinds",
    """WITH named AS (SELECT lower(regexp_extract(concat('/in/', regexp_replace(p_name, ' ', '_', 'g'),
    CASE p_size % 6 WHEN 0 THEN '.CSV' WHEN 1 THEN '.json' WHEN 2 THEN '.xml' WHEN 3 THEN '.tar.gz' WHEN 4 THEN '.bin' ELSE '' END),
    '([^/]*)$', 1)) AS name FROM part)
    SELECT coalesce(regexp_extract(name, '(\\.tar\\.gz|\\.[^.]*)$', 1), '') AS ext,
    CASE regexp_extract(name, '(\\.tar\\.gz|\\.[^.]*)$', 1) WHEN '.csv' THEN 'csv' WHEN '.json' THEN 'json' WHEN '.xml' THEN 'xml'
    WHEN '.tar.gz' THEN 'archive' ELSE 'unsupported' END AS reader, count(*) AS files FROM named GROUP BY ALL""",
)
def sc6(spark, sf):
    suffix = "CASE p_size % 6 WHEN 0 THEN '.CSV' WHEN 1 THEN '.json' WHEN 2 THEN '.xml' WHEN 3 THEN '.tar.gz' WHEN 4 THEN '.bin' ELSE '' END"
    path = F.expr(f"concat('/in/', replace(p_name, ' ', '_'), {suffix})")
    named = table(spark, sf, "part").select(files.extension(path).alias("ext"))
    return named.groupBy("ext").agg(F.count(F.lit(1)).alias("files")).withColumn("reader", files.reader_of(F.col("ext")))


@query("sc7_table_scan", "SELECT * FROM customer")
def sc7(spark, sf):
    return table(spark, sf, "customer")


@query(
    "sc8_hash_to_id",
    """SELECT job_hash, arg_max(concat('e', seq), seq) AS eid FROM hashed WHERE status IS NOT NULL GROUP BY job_hash""",
    view=True,
)
def sc8(spark, sf):
    mirror = hashed_postings(spark, sf).select(
        "seq", "job_hash", F.when(F.col("status").isNotNull(), F.concat(F.lit("e"), F.col("seq"))).alias("eid")
    )
    return tables.hash_to_id(mirror, "seq")


@query(
    "sc10_deletion_list",
    """SELECT 'hash' AS kind, CAST(o_custkey AS VARCHAR) AS value FROM orders GROUP BY ALL
    UNION ALL SELECT 'eid', o_orderpriority FROM orders GROUP BY ALL""",
)
def sc10(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "deletions")
    rows = orders.groupBy(F.col("o_custkey").cast("string").alias("hash")).agg(F.collect_set("o_orderpriority").alias("eids"))
    rows.write.json(path)
    hashes, ids = tables_of(files.read_deletion_list(spark, path))
    return hashes.unionByName(ids)


def tables_of(deletions):
    hashes, ids = files.deletion_keys(deletions)
    return (
        hashes.select(F.lit("hash").alias("kind"), F.col("job_hash").alias("value")),
        ids.select(F.lit("eid").alias("kind"), F.col("eid").alias("value")),
    )


@query(
    "pf1_field_mapping",
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 40 THEN p_type END, p_name) AS title, p_brand AS company_name FROM part""",
)
def pf1(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("jobTitle"), F.col("p_brand").alias("employer"),
        F.when(F.col("p_size") > 40, F.col("p_type")).otherwise(F.lit("  ")).alias("position"), "p_size",
    )
    filled = lambda name: F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))
    fields = {"p_partkey": "p_partkey", "jobTitle": "title", "position": "title", "employer": "company_name"}
    return raw.select(*feeds.mapped_fields(fields, filled)).withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query(
    "pf1b_aliases",
    "SELECT p_partkey AS external_job_id, p_name AS title, p_brand AS company_name, p_retailprice AS salary_min FROM part",
)
def pf1b(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").alias("requisition_id"), F.col("p_name").alias("position_title"),
        F.col("p_brand").alias("hiring_organization"), F.col("p_retailprice").alias("minimum_salary"),
        F.col("p_type").alias("feed_source_name"), F.col("p_size").alias("cpc"),
    )
    return mapping.apply_aliases(raw, list(validate.POSTING_RULES))


STANDARD_SQL = f"""SELECT seq, CASE WHEN status IS NOT NULL THEN CASE WHEN {CLOSED_SQL} THEN 'CLOSED' ELSE 'ACTIVE' END END AS status,
    CASE WHEN upper(regexp_replace(employment_type, '[^A-Za-z0-9]', '', 'g')) = 'FULLTIME' THEN 'FULL_TIME' ELSE 'PART_TIME' END AS employment_type,
    lower(is_remote) IN ('true', '1', 'yes') AS is_remote, TRY_CAST(salary_min AS DOUBLE) AS salary_min,
    regexp_replace(description, '&amp;?', '&', 'g') AS description FROM postings"""


@query("pf2_standardise", STANDARD_SQL, view=True)
def pf2(spark, sf):
    return mapping.standardise(postings(spark, sf)).select(
        "seq", "status", "employment_type", "is_remote", "salary_min", "description"
    )


@query("pf3_drop_closed", f"SELECT seq, status FROM postings WHERE NOT {CLOSED_SQL}", view=True)
def pf3(spark, sf):
    rows = light_postings(spark, sf).select("seq", "status")
    marked = rows.withColumn("raw", F.col("status")).withColumn(
        "status", F.when(F.col("status").isNotNull(), text.posting_status(F.col("status")))
    )
    return mapping.drop_closed(marked).select("seq", F.col("raw").alias("status"))


@query(
    "pf4_finalise",
    """SELECT seq, ai_confidence_score, feed_id, CAST(NULL AS INTEGER) AS partner_id, concat('feed ', feed_id) AS job_source,
    '2024-02-01 00:00:00' AS created_at, '2024-02-01 00:00:00' AS updated_at FROM postings""",
    view=True,
)
def pf4(spark, sf):
    rows = light_postings(spark, sf).select("seq", F.col("ai_confidence_score").alias("confidence_score"), "feed_id", "company_name")
    out = mapping.finalise(
        rows, F.col("feed_id"), F.concat(F.lit("feed "), F.col("feed_id")), mapping.partner_id(F.col("company_name")), datetime(2024, 2, 1)
    )
    stamp = "yyyy-MM-dd HH:mm:ss"
    return out.select(
        "seq", "ai_confidence_score", "feed_id", "partner_id", "job_source",
        F.date_format("created_at", stamp).alias("created_at"), F.date_format("updated_at", stamp).alias("updated_at"),
    )


@query(
    "pf5_conform",
    f"""SELECT external_job_id, {HASH_SQL} AS job_hash, TRY_CAST(salary_min AS DOUBLE) AS salary_min, 0.0::DOUBLE AS salary_max,
    false AS is_international, 0 AS tasks, CAST(NULL AS INTEGER) AS sector_id, feed_id, 48 AS n_columns FROM postings""",
    view=True,
)
def pf5(spark, sf):
    raw = postings(spark, sf).withColumn("salary_min", F.col("salary_min").try_cast("double"))
    out = mapping.conform(raw.drop("locations", "is_remote"))
    return out.select(
        "external_job_id", "job_hash", "salary_min", "salary_max", "is_international", F.size("ai_job_tasks").alias("tasks"),
        "sector_id", "feed_id", F.lit(len(out.columns)).alias("n_columns"),
    )


@query(
    "pf6_partner",
    """SELECT c_custkey, CASE lower(trim(c_mktsegment)) WHEN 'building' THEN 7 WHEN 'machinery' THEN 15 WHEN 'household' THEN 12 END AS partner_id
    FROM customer""",
)
def pf6(spark, sf):
    names = F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN ' Buyer ' WHEN 'MACHINERY' THEN 'JOB TARGET' WHEN 'HOUSEHOLD' THEN 'Zip Recruiter' ELSE c_mktsegment END")
    return table(spark, sf, "customer").select("c_custkey", mapping.partner_id(names).alias("partner_id"))


@query(
    "pf9_migrate_feeds",
    """SELECT s_name AS name, '' AS parser_type, CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS company_name,
    s_acctbal >= 0 AS is_active, s_nationkey AS check_frequency_minutes, s_nationkey AS error_count FROM supplier""",
)
def pf9(spark, sf):
    old = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("company"),
        F.when(F.col("s_acctbal") >= 0, "active").otherwise("paused").alias("status"),
        F.col("s_nationkey").alias("polling_interval"), F.col("s_nationkey").alias("error_count"),
    )
    return mapping.migrate_feeds(old).select(
        "name", "parser_type", "company_name", "is_active", "check_frequency_minutes", "error_count"
    )


@query(
    "pf10_preview",
    """SELECT seq, CASE WHEN length(description) > 100 THEN concat(substr(description, 1, 100), '...') ELSE description END AS description
    FROM postings ORDER BY seq LIMIT 5""",
    view=True,
)
def pf10(spark, sf):
    """The report shows five rows; the limit is the feature."""
    return audit.preview(light_postings(spark, sf).select("seq", "description").orderBy("seq"))


def candidate_rows(spark, sf):
    """Parts as postings that break a rule here and there."""
    return select_sql(
        table(spark, sf, "part"),
        """CAST(p_partkey AS STRING) AS external_job_id,
        CASE WHEN p_size < 10 THEN 'COMPANY_WEBSITE' WHEN p_size = 50 THEN 'EMAIL' ELSE 'JOB_FEED' END AS job_source,
        CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS feed_id,
        '2024-01-01T00:00:00Z' AS created_at, '2024-01-02T00:00:00Z' AS updated_at,
        CASE WHEN p_size = 33 THEN 'yesterday' ELSE '2024-01-01' END AS posted_at,
        'ACTIVE' AS status, p_brand AS company_name, p_name AS title,
        CASE WHEN p_size = 21 THEN NULL ELSE p_type END AS description,
        false AS is_remote, false AS is_multi_location, false AS is_international, p_retailprice AS salary_min, p_size""",
    )


VALID_SQL = """WITH c AS (SELECT *, CASE WHEN p_size < 10 THEN 'COMPANY_WEBSITE' WHEN p_size = 50 THEN 'EMAIL' ELSE 'JOB_FEED' END AS js,
    p_size % 7 = 0 AS no_feed FROM part),
    e AS (SELECT CAST(p_partkey AS VARCHAR) AS external_job_id, p_brand,
    CAST(p_size = 50 AS INT) + CAST(p_size = 33 AS INT) + CAST(p_size = 21 AS INT) + CAST(js = 'JOB_FEED' AND no_feed AS INT)
    + CAST(js = 'COMPANY_WEBSITE' AND NOT no_feed AS INT) AS n_errors FROM c)"""


@query("pf11_validate", VALID_SQL + " SELECT external_job_id, n_errors, n_errors = 0 AS is_valid FROM e")
def pf11(spark, sf):
    return validate.validate(candidate_rows(spark, sf)).select(
        "external_job_id", F.size("errors").alias("n_errors"), "is_valid"
    )


@query("sk15_load_valid", VALID_SQL + " SELECT external_job_id, p_brand AS company_name, 14 AS n_columns FROM e WHERE n_errors = 0")
def sk15(spark, sf):
    path = scratch_path(spark, "valid")
    validate.load_valid(candidate_rows(spark, sf), path)
    loaded = spark.read.parquet(path)
    return loaded.select("external_job_id", "company_name", F.lit(len(loaded.columns)).alias("n_columns"))


@query(
    "flagship_company_postings",
    f"""SELECT company_name, count(*) AS postings, count(DISTINCT job_hash) AS distinct_hashes FROM (
    SELECT company_name, {HASH_SQL} AS job_hash FROM postings WHERE NOT {CLOSED_SQL}) GROUP BY company_name""",
    view=True,
)
def flagship(spark, sf):
    """Standardise, drop closed postings, hash, and count postings and distinct hashes per company."""
    rows = postings(spark, sf).select("title", "company_name", "employment_type", "description", "status")
    standard = rows.withColumns(
        {
            "status": text.posting_status(F.col("status")),
            "employment_type": text.employment_type(F.col("employment_type")),
        }
    )
    hashed = mapping.drop_closed(standard).select("company_name", canonical_hash().alias("job_hash"))
    per_hash = hashed.groupBy("company_name", "job_hash").agg(F.count(F.lit(1)).alias("copies"))
    return per_hash.groupBy("company_name").agg(
        F.sum("copies").alias("postings"), F.count(F.lit(1)).alias("distinct_hashes")
    )


@query("wn1_last_per_hash", "SELECT job_hash, max(seq) AS seq, arg_max(external_job_id, seq) AS external_job_id FROM hashed GROUP BY job_hash", view=True)
def wn1(spark, sf):
    rows = hashed_postings(spark, sf).select("job_hash", "seq", "external_job_id")
    return ordinals.last_per_key(rows, "job_hash", "seq")


@query("wn2_first_per_hash", "SELECT job_hash, min(seq) AS seq, arg_min(external_job_id, seq) AS external_job_id FROM hashed GROUP BY job_hash", view=True)
def wn2(spark, sf):
    rows = hashed_postings(spark, sf).select("job_hash", "seq", "external_job_id")
    return ordinals.first_per_key(rows, "job_hash", "seq")


@query(
    "ag13_rehash",
    f"""SELECT job_hash, count(*) AS rows, count(*) FILTER (WHERE {HASH_SQL} <> job_hash) AS mismatches FROM (
    SELECT title, company_name, employment_type, description, CASE WHEN feed_id = 3 THEN concat('old-', seq) ELSE job_hash END AS job_hash FROM hashed) GROUP BY job_hash""",
    view=True,
)
def ag13(spark, sf):
    stored = hashed_postings(spark, sf).withColumn(
        "job_hash", F.when(F.col("feed_id") == 3, F.concat(F.lit("old-"), F.col("seq"))).otherwise(F.col("job_hash"))
    )
    return audit.rehash(stored)


@query(
    "jn13_hash_source",
    f"""SELECT DISTINCT p.seq AS id, h.job_hash, h.recipe FROM postings p, LATERAL (SELECT * FROM (VALUES
    ('title', to_base64(unhex(sha256(concat(title, '|||'))))),
    ('title, company', to_base64(unhex(sha256(concat(title, '|', company_name, '||')))))) v(recipe, job_hash)) h""",
    view=True,
)
def jn13(spark, sf):
    """Hashes made from the title alone or with the company, found again among all recipes of all rows."""
    rows = postings(spark, sf).select("seq", "title", "company_name", "description")
    blank = F.lit("")
    short = F.array(
        base64_sha256(F.concat_ws("|", "title", blank, blank, blank)),
        base64_sha256(F.concat_ws("|", "title", "company_name", blank, blank)),
    )
    return audit.find_hash_source(rows, rows.select(F.explode(short).alias("job_hash")))


