"""Queries of table upkeep: upsert, replace, archive, delete, diff, lookups and set operations.

The stored table holds the orders placed before 1999, the feed those placed since 1996, with another
status and amount. Both are read whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedloom.functions.hashing import canonical_hash
from feedloom.operators import bucketed, digests, keytests, ordinals, reports, routing, tables
from feedloom.plans.registry import hashed_postings, light_postings, postings, query, select_sql, table
from feedloom.session import scratch_path

STORED = """CAST(o_orderkey AS STRING) AS job_hash, o_orderstatus AS status, o_totalprice AS amount,
    o_orderpriority AS feed, CAST(o_orderkey + 1000000 AS BIGINT) AS id, CAST(o_orderdate AS DATE) AS created_at"""
FED = """CAST(o_orderkey AS STRING) AS job_hash, concat('new ', o_orderstatus) AS status, o_totalprice * 2 AS amount,
    o_orderpriority AS feed, CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS created_at, o_orderkey"""
SNAPSHOTS = f"""WITH stored AS (SELECT {STORED} FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
    feed AS (SELECT {FED} FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00')"""
BEFORE, SINCE = "o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'", "o_orderdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00'"


def stored_orders(spark, sf):
    return select_sql(table(spark, sf, "orders").filter(BEFORE), STORED)


def fed_orders(spark, sf):
    return select_sql(table(spark, sf, "orders").filter(SINCE), FED).withColumn(
        "created_at", F.col("created_at").cast("date")
    )


def dated(df):
    return df.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd"))


UPSERT_SQL = SNAPSHOTS + """
    SELECT job_hash, coalesce(f.status, s.status) AS status, coalesce(f.amount, s.amount) AS amount,
    coalesce(f.feed, s.feed) AS feed, s.id AS id, strftime(coalesce(s.created_at, f.created_at), '%Y-%m-%d') AS created_at
    FROM stored s FULL JOIN feed f USING (job_hash)"""


@query("sk1_upsert", UPSERT_SQL)
def sk1(spark, sf):
    return dated(tables.upsert(stored_orders(spark, sf), fed_orders(spark, sf), order="o_orderkey"))


@query(
    "sk2_replace_feed",
    SNAPSHOTS + """, building AS (SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey),
    s AS (SELECT job_hash, status, c_name AS feed_id FROM stored JOIN building ON job_hash = CAST(building.o_orderkey AS VARCHAR)),
    f AS (SELECT job_hash, status, c_name AS feed_id FROM feed JOIN building ON job_hash = CAST(building.o_orderkey AS VARCHAR)
          WHERE c_name IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'))
    SELECT * FROM s WHERE feed_id NOT IN (SELECT feed_id FROM f) UNION ALL SELECT * FROM f""",
)
def sk2(spark, sf):
    """Feeds are customers; those of one segment deliver anew."""
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("feed_id"), "c_mktsegment")
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("job_hash"), "o_custkey").join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    stored = stored_orders(spark, sf).join(owner, "job_hash").select("job_hash", "status", "feed_id")
    fed = fed_orders(spark, sf).join(owner.filter("c_mktsegment = 'BUILDING'"), "job_hash")
    return tables.replace_feed(stored, fed.select("job_hash", "status", "feed_id"))


def order_states(spark, sf):
    rows = select_sql(table(spark, sf, "orders"), STORED)
    return {name: rows.filter(F.col("status") == name) for name in ("O", "P", "F")}


IN_DEBT = "SELECT CAST(o_orderkey AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0"


def keys_in_debt(spark, sf):
    debt = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("job_hash"))
    return orders.join(debt, "o_custkey", "left_semi").select("job_hash")


@query(
    "sk3_archive_move",
    f"""SELECT CASE WHEN o_orderstatus = 'F' OR CAST(o_orderkey AS VARCHAR) IN ({IN_DEBT}) THEN 'archive' ELSE 'open' END AS place,
    CAST(o_orderkey AS VARCHAR) AS job_hash, o_totalprice AS amount FROM orders WHERE o_orderstatus IN ('O', 'F')""",
)
def sk3(spark, sf):
    states = order_states(spark, sf)
    now_open, archived, _ = tables.archive(states["O"], states["F"], keys_in_debt(spark, sf))
    return tables.all_states(open=now_open, archive=archived).select(F.col("state").alias("place"), "job_hash", "amount")


@query(
    "sk3_archive_check",
    f"""SELECT count(*) AS deleted, count(*) AS copied, true AS counts_match FROM orders WHERE o_orderstatus = 'O'
    AND CAST(o_orderkey AS VARCHAR) IN ({IN_DEBT})""",
)
def sk3_check(spark, sf):
    states = order_states(spark, sf)
    now_open, _, moved = tables.archive(states["O"], states["F"], keys_in_debt(spark, sf))
    return tables.archive_check(states["O"], now_open, moved)


RETURNED = "SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R'"


def returned_keys(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return lines.select(F.col("l_orderkey").cast("string").alias("job_hash")).distinct()


@query("sk4_delete_keys", f"SELECT CAST(o_orderkey AS VARCHAR) AS job_hash, o_totalprice AS amount FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN ({RETURNED})")
def sk4(spark, sf):
    rows = select_sql(table(spark, sf, "orders"), STORED)
    return tables.delete_keys(rows, returned_keys(spark, sf)).select("job_hash", "amount")


@query(
    "sk5_warehouse_merge",
    SNAPSHOTS + """ SELECT job_hash, CASE WHEN s.job_hash IS NOT NULL THEN concat('w', s.job_hash) ELSE 'new' END AS bigquery_id,
    coalesce(f.status, s.status) AS status, strftime(coalesce(s.created_at, f.created_at), '%Y-%m-%d') AS created_at
    FROM stored s FULL JOIN feed f USING (job_hash)""",
)
def sk5(spark, sf):
    stored = stored_orders(spark, sf).select(
        F.concat(F.lit("w"), "job_hash").alias("bigquery_id"), "job_hash", "status", "created_at"
    )
    return dated(tables.warehouse_merge(stored, fed_orders(spark, sf).withColumn("bigquery_id", F.lit("new"))))


@query(
    "sk8_review_queue",
    """SELECT 'pending' AS review_status, seq, ai_confidence_score FROM postings
    WHERE ai_confidence_score IS NULL OR (ai_confidence_score >= 50 AND ai_confidence_score < 86)""",
    view=True,
)
def sk8(spark, sf):
    return written_queue(spark, sf).select("review_status", "job_data.seq", "job_data.ai_confidence_score")


def written_queue(spark, sf):
    rows = routing.with_route(light_postings(spark, sf).select("seq", "title", "ai_confidence_score"))
    path = scratch_path(spark, "queue")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    routing.send_to_review(rows.filter("status = 'MANUAL_REVIEW'"), now, path)
    return spark.read.parquet(path)


@query(
    "ag9_queue_status",
    """SELECT count(*) AS total_items, count(*) AS pending_items FROM postings
    WHERE ai_confidence_score IS NULL OR (ai_confidence_score >= 50 AND ai_confidence_score < 86)""",
    view=True,
)
def ag9(spark, sf):
    return routing.queue_status(written_queue(spark, sf))


@query(
    "sk9_approve",
    f"""SELECT CASE WHEN o_orderstatus = 'O' OR CAST(o_orderkey AS VARCHAR) IN ({IN_DEBT}) THEN 'open' ELSE 'review' END AS place,
    CAST(o_orderkey AS VARCHAR) AS job_hash,
    CASE WHEN o_orderstatus = 'P' AND CAST(o_orderkey AS VARCHAR) IN ({IN_DEBT}) THEN 'ACTIVE' ELSE o_orderstatus END AS status
    FROM orders WHERE o_orderstatus IN ('O', 'P')""",
)
def sk9(spark, sf):
    states = {k: v.withColumn("updated_at", F.col("created_at")) for k, v in order_states(spark, sf).items()}
    review, now_open, _ = tables.approve(
        states["P"], states["O"], keys_in_debt(spark, sf), F.lit("2024-02-01").cast("date")
    )
    return tables.all_states(open=now_open, review=review).select(F.col("state").alias("place"), "job_hash", "status")


@query(
    "sk12_purge",
    f"""SELECT CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'review' ELSE 'archive' END AS store, count(*) AS deleted
    FROM orders WHERE CAST(o_orderkey AS VARCHAR) IN ({RETURNED}) GROUP BY ALL""",
)
def sk12(spark, sf):
    states = order_states(spark, sf)
    stores = {"open": states["O"], "review": states["P"], "archive": states["F"]}
    return tables.purge(stores, returned_keys(spark, sf))[1]


@query(
    "sk13_merge_mapping",
    """WITH o AS (SELECT c_nationkey, c_mktsegment, max(c_name) AS n FROM customer GROUP BY ALL),
    f AS (SELECT c_nationkey, c_mktsegment, min(c_name) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY ALL)
    SELECT c_nationkey, c_mktsegment AS source, coalesce(f.n, o.n) AS target FROM o FULL JOIN f USING (c_nationkey, c_mktsegment)""",
)
def sk13(spark, sf):
    from feedloom.operators.mapping import merge_mappings

    customers = table(spark, sf, "customer")

    def maps(rows, pick, name):
        pairs = rows.groupBy("c_nationkey", "c_mktsegment").agg(pick("c_name").alias("n"))
        entries = F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n")))
        return pairs.groupBy("c_nationkey").agg(entries.alias(name))

    old = maps(customers, F.max, "old")
    new = maps(customers.filter("c_acctbal > 5000"), F.min, "new")
    both = old.join(new, "c_nationkey", "left")
    merged = F.when(F.col("new").isNull(), F.col("old")).otherwise(merge_mappings(F.col("old"), F.col("new")))
    return both.select("c_nationkey", F.explode(merged).alias("source", "target"))


@query("jn1_closed_keys", SNAPSHOTS + " SELECT job_hash FROM stored WHERE job_hash NOT IN (SELECT job_hash FROM feed)")
def jn1(spark, sf):
    active = stored_orders(spark, sf).withColumn("status", F.lit("ACTIVE"))
    return tables.closed_keys(active, fed_orders(spark, sf))


@query(
    "jn2_two_way_diff",
    SNAPSHOTS + """ SELECT job_hash, CASE WHEN f.job_hash IS NULL THEN 'delete' ELSE 'add' END AS action
    FROM stored s FULL JOIN feed f USING (job_hash) WHERE f.job_hash IS NULL OR s.job_hash IS NULL""",
)
def jn2(spark, sf):
    return tables.diff(fed_orders(spark, sf), stored_orders(spark, sf))


@query(
    "jn3_existing_keys",
    f"SELECT DISTINCT k AS job_hash FROM ({IN_DEBT}) t(k) WHERE k IN ({RETURNED}) OR k IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')",
)
def jn3(spark, sf):
    states = order_states(spark, sf)
    return tables.existing_keys(keys_in_debt(spark, sf), [returned_keys(spark, sf), states["P"]])


@query(
    "jn4_stored_or_new_id",
    SNAPSHOTS + """ SELECT job_hash, CASE WHEN s.id IS NOT NULL THEN CAST(s.id AS VARCHAR) ELSE
    concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) END AS bigquery_id
    FROM (SELECT job_hash, sha256(job_hash) AS h FROM feed) f LEFT JOIN stored s USING (job_hash)""",
)
def jn4(spark, sf):
    stored = stored_orders(spark, sf).select("job_hash", F.col("id").cast("string").alias("bigquery_id"))
    return tables.with_ids(fed_orders(spark, sf).select("job_hash"), stored)


@query(
    "jn10_new_rows",
    """SELECT job_hash, min(seq) AS seq FROM hashed WHERE job_hash NOT IN
    (SELECT job_hash FROM hashed JOIN labels ON seq = doc_id) GROUP BY job_hash""",
    view=True,
)
def jn10(spark, sf):
    """Labelled postings are stored; the first row of every other hash is new."""
    rows = hashed_postings(spark, sf).select("job_hash", "seq")
    labelled = postings(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").alias("seq")), "seq", "left_semi")
    known = labelled.select(canonical_hash().alias("job_hash"))
    return tables.new_rows(rows, known, "seq")


@query(
    "jn11_delete_ids",
    SNAPSHOTS + " SELECT job_hash, concat('e', s.id) AS eid FROM stored s WHERE job_hash NOT IN (SELECT job_hash FROM feed)",
)
def jn11(spark, sf):
    mirror = stored_orders(spark, sf).select("job_hash", F.concat(F.lit("e"), "id").alias("eid"))
    gone = tables.diff(fed_orders(spark, sf), mirror).filter("action = 'delete'")
    return gone.join(mirror, "job_hash").select("job_hash", "eid")


@query("so1_union_of_keys", f"SELECT k AS job_hash FROM ({IN_DEBT}) t(k) UNION SELECT k FROM ({RETURNED}) t(k)")
def so1(spark, sf):
    return keys_in_debt(spark, sf).unionByName(returned_keys(spark, sf)).distinct()


@query(
    "so2_all_states",
    """SELECT CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'review' ELSE 'archive' END AS state,
    CAST(o_orderkey AS VARCHAR) AS job_hash, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS amount FROM orders""",
)
def so2(spark, sf):
    states = order_states(spark, sf)
    both = tables.all_states(open=states["O"], review=states["P"].drop("amount"), archive=states["F"])
    return both.select("state", "job_hash", "amount")


@query("so3_key_difference", f"SELECT k AS job_hash FROM ({IN_DEBT}) t(k) EXCEPT SELECT k FROM ({RETURNED}) t(k)")
def so3(spark, sf):
    return keys_in_debt(spark, sf).distinct().join(returned_keys(spark, sf), "job_hash", "left_anti")


@query(
    "so4_shared_words",
    """WITH w AS (SELECT item_id, list_distinct(string_split(lower(text), ' ')) AS words FROM benchmark),
    n AS (SELECT item_id + 1 AS item_id, words FROM w)
    SELECT w.item_id, len(list_intersect(w.words, n.words)) AS shared FROM w JOIN n USING (item_id)""",
)
def so4(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", F.array_distinct(F.split(F.lower("text"), " ")).alias("words"))
    before = rows.select((F.col("item_id") + 1).alias("item_id"), F.col("words").alias("before"))
    return rows.join(before, "item_id").select("item_id", F.size(F.array_intersect("words", "before")).alias("shared"))


@query("sl1_latest_order", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def sl1(spark, sf):
    """The newest row; the limit is the feature."""
    newest = table(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1)
    return newest.select("o_orderkey", "o_totalprice")


@query("sl2_sample_rows", "SELECT 10 AS n FROM postings LIMIT 1", view=True)
def sl2(spark, sf):
    """The inspector looks at ten rows; the limit is the feature."""
    return light_postings(spark, sf).select("seq").limit(10).agg(F.count(F.lit(1)).cast("int").alias("n"))


@query(
    "sl4_sample_per_key",
    """SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256(CAST(o_orderkey AS VARCHAR))) AS rn,
    count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE rn <= greatest(floor(n * 0.2), 5)""",
)
def sl4(spark, sf):
    """A fifth of the orders of each priority; the sample is the feature."""
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return ordinals.sample_per_key(rows, ["o_orderpriority"], "o_orderkey", 0.2)


@query(
    "sl3_sorted_groups",
    """SELECT feed_id, string_agg(DISTINCT locations, ';' ORDER BY locations) AS places, min(job_hash) AS first_hash FROM hashed GROUP BY feed_id""",
    view=True,
)
def sl3(spark, sf):
    rows = hashed_postings(spark, sf).select("feed_id", "locations", "job_hash")
    names = rows.filter("locations IS NOT NULL").select("feed_id", "locations").distinct()
    sorted_names = names.groupBy("feed_id").agg(F.array_join(F.array_sort(F.collect_list("locations")), ";").alias("places"))
    return rows.groupBy("feed_id").agg(F.min("job_hash").alias("first_hash")).join(sorted_names, "feed_id")


@query(
    "wn4_batch_numbers",
    """SELECT o_orderkey, o_orderpriority, CAST((rn - 1) // 250 + 1 AS BIGINT) AS batch_no, CAST(ceil(n / 250.0) AS BIGINT) AS total_batches,
    ['east', 'west', 'south'][CAST(((rn - 1) // 250) % 3 + 1 AS INT)] AS region FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn,
    count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)""",
)
def wn4(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    batched = ordinals.with_batch(rows, ["o_orderpriority"], "o_orderkey", 250, width=5000)
    return batched.select(
        "o_orderkey", "o_orderpriority", "batch_no", "total_batches",
        ordinals.region("batch_no", ["east", "west", "south"]).alias("region"),
    )


@query(
    "ag12_verify_copy",
    """SELECT count(*) AS source_count, count(*) AS dest_count, true AS counts_match, true AS rows_match, true AS schema_match FROM customer""",
)
def ag12(spark, sf):
    from feedloom.operators.audit import verify_copy

    source = table(spark, sf, "customer")
    path = scratch_path(spark, "copy")
    source.write.parquet(path)
    return verify_copy(source, spark.read.parquet(path))


@query(
    "ag14_hash_sample",
    """+ d AS (SELECT DISTINCT feed_id, job_hash FROM hashed),
    r AS (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY job_hash) AS rn FROM d)
    SELECT feed_id, count(*) AS unique_hashes, string_agg(job_hash, ',' ORDER BY job_hash) FILTER (WHERE rn <= 5) AS sample FROM r GROUP BY feed_id""",
    view=True,
)
def ag14(spark, sf):
    out = reports.hash_sample(hashed_postings(spark, sf).select("feed_id", "job_hash"), ["feed_id"])
    return out.withColumn("sample", F.array_join("sample", ","))


@query("pf15_active_feeds", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0")
def pf15(spark, sf):
    return table(spark, sf, "supplier").filter("s_acctbal >= 0").select("s_suppkey", "s_name")


@query(
    "pf16_active_hashes",
    "SELECT feed, job_hash FROM (SELECT CAST(o_orderkey AS VARCHAR) AS job_hash, o_orderpriority AS feed, o_orderstatus AS status FROM orders) WHERE status = 'O'",
)
def pf16(spark, sf):
    rows = select_sql(table(spark, sf, "orders"), STORED)
    return rows.filter((F.col("status") == "O") & F.col("job_hash").isNotNull()).select("feed", "job_hash")


@query("pf16_rows_by_key", f"SELECT CAST(o_orderkey AS VARCHAR) AS job_hash, o_totalprice AS amount FROM orders WHERE CAST(o_orderkey AS VARCHAR) IN ({RETURNED})")
def pf16_rows(spark, sf):
    rows = select_sql(table(spark, sf, "orders"), STORED)
    return tables.rows_of(rows, returned_keys(spark, sf)).select("job_hash", "amount")


@query("fn27_random_ids")
def fn27(spark, sf):
    return tables.with_random_ids(light_postings(spark, sf).select("seq"), "uuid")


def digested(spark, rows, key, label, depth=1):
    """A table stored with its digests."""
    return digests.store(rows, scratch_path(spark, label), key, depth)


@query(
    "jn2_digest_diff",
    SNAPSHOTS + """, c AS (SELECT job_hash, CASE WHEN f.job_hash IS NULL THEN 'delete' WHEN s.job_hash IS NULL THEN 'add' WHEN s.status IS DISTINCT FROM f.status THEN 'change' END AS action
    FROM stored s FULL JOIN feed f USING (job_hash)) SELECT * FROM c WHERE action IS NOT NULL""",
)
def jn2_digests(spark, sf):
    """Added, deleted and changed rows of two stored tables, found by their digests."""
    feed, stored = (rows(spark, sf).select("job_hash", "status") for rows in (fed_orders, stored_orders))
    return digests.diff_stored(*digested(spark, feed, "job_hash", "feed"), *digested(spark, stored, "job_hash", "stored"), "job_hash", 1)


@query(
    "ag12_digest_copy",
    """SELECT count(*) AS left_rows, count(*) FILTER (WHERE l_orderkey <> (SELECT min(l_orderkey) FROM lineitem)) AS right_rows, false AS counts_match, false AS content_match, 1 AS differing_leaves FROM lineitem""",
)
def ag12_digests(spark, sf):
    """A copy that lacks the rows of one key: its leaf alone differs."""
    rows = table(spark, sf, "lineitem")
    copy = rows.filter(F.col("l_orderkey") != rows.agg(F.min("l_orderkey")).first()[0])
    sides = [digested(spark, side, "l_orderkey", "copy")[1] for side in (rows, copy)]
    return digests.verify_copy(*sides, depth=1)


def bucketed_orders(spark, sf):
    """The stored orders as a bucketed catalog table."""
    versions = bucketed.Versions(spark, f"orders_{uuid.uuid4().hex}", buckets=8)
    versions.write(stored_orders(spark, sf))
    return versions


@query("sk1_bucketed_upsert", UPSERT_SQL)
def sk1_bucketed(spark, sf):
    """The feed's orders upserted into a table that stays where it is."""
    versions = bucketed_orders(spark, sf)
    versions.upsert(fed_orders(spark, sf), order="o_orderkey")
    return dated(versions.read())


@query("jn1_bucketed_closed", SNAPSHOTS + " SELECT job_hash FROM stored WHERE job_hash NOT IN (SELECT job_hash FROM feed)")
def jn1_bucketed(spark, sf):
    versions = bucketed.Versions(spark, f"active_{uuid.uuid4().hex}", buckets=8)
    versions.write(stored_orders(spark, sf).withColumn("status", F.lit("ACTIVE")))
    return bucketed.closed_keys(versions.read(), fed_orders(spark, sf))


@query(
    "jn3_filtered_keys",
    f"SELECT DISTINCT k AS job_hash FROM ({IN_DEBT}) t(k) WHERE k IN ({RETURNED}) OR k IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')",
)
def jn3_filtered(spark, sf):
    """The stores meet a filter of the keys before they are shuffled."""
    return keytests.existing_keys(keys_in_debt(spark, sf), [returned_keys(spark, sf), order_states(spark, sf)["P"]])


@query(
    "jn10_filtered_rows",
    SNAPSHOTS + " SELECT job_hash, status FROM feed WHERE job_hash NOT IN (SELECT job_hash FROM stored)",
)
def jn10_filtered(spark, sf):
    rows = fed_orders(spark, sf)
    return keytests.new_rows(rows, stored_orders(spark, sf), "o_orderkey").select("job_hash", "status")
