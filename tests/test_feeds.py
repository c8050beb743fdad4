import gzip
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.operators import audit, mapping, validate
from feedloom.sources import batches, feeds, files

FEED = """<?xml version="1.0"?><source>
<job><Title>Nurse</Title><company>R&D Clinic</company><url>https://x.y/a?b=1&amp;c=2&d=3</url><city>Boston</city></job>
<job><title><![CDATA[Lead <b>Nurse</b>]]></title><company>It&#39;s us</company><description>one
two</description></job>
<job><title>Broken<company>x</company></job>
<job id="7" TITLE="From attribute"><company>Attr</company></job>
<job><title>NUL\x00free</title><location> </location></job>
<job><other>nothing mapped</other></job>
<job><title>Truncated"""
MAPPINGS = {"title": "title", "headline": "title", "company": "company_name", "url": "application_url", "city": "city",
            "description": "description", "location": "locations"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("feed")
    (path / "feed.xml").write_text(FEED, encoding="utf-8")
    with gzip.open(path / "feed.xml.gz", "wt", encoding="utf-8") as f:
        f.write(FEED)
    return path


@pytest.mark.parametrize("name", ["feed.xml", "feed.xml.gz"])
def test_scan(spark, folder, name):
    rows = feeds.read_feed(spark, str(folder / name), MAPPINGS).orderBy("position").collect()
    assert [r["title"] for r in rows] == ["Nurse", "Lead <b>Nurse</b>", "NULfree"]
    assert rows[0]["company_name"] == "R&D Clinic"
    assert rows[0]["application_url"] == "https://x.y/a?b=1&c=2&d=3"
    assert rows[1]["company_name"] == "It&#39;s us"
    assert rows[1]["description"] == "one\ntwo"
    assert rows[2]["locations"] is None


def test_entities_are_resolved_when_fields_are_standardised(spark, folder):
    rows = mapping.standardise(feeds.read_feed(spark, str(folder / "feed.xml"), MAPPINGS).drop("position", "file_path", "file_size"))
    got = {r["title"]: r for r in rows.collect()}
    assert got["Lead <b>Nurse</b>"]["company_name"] == "It's us"
    assert [tuple(x) for x in got["Nurse"]["locations"]] == [("Boston", None, "US")]


def test_attributes_are_an_option(spark, folder):
    rows = feeds.read_feed(spark, str(folder / "feed.xml"), MAPPINGS, attributes=True).collect()
    assert {r["title"] for r in rows} == {"Nurse", "Lead <b>Nurse</b>", "NULfree", "From attribute"}


def test_own_extractor(spark, folder):
    rows = feeds.read_feed(spark, str(folder / "feed.xml"), MAPPINGS, extract=lambda tag: F.upper(F.col("job")[tag]))
    assert "NURSE" in {r["title"] for r in rows.collect()}


def test_many_splits_lose_nothing(spark, tmp_path):
    body = "".join(f"<job><title>t{i}</title><description>{'word ' * (i % 50)}</description></job>\n" for i in range(5000))
    (tmp_path / "big.xml").write_text(f"<source>{body}</source>", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = feeds.read_feed(spark, str(tmp_path / "big.xml"), {"title": "title"})
        assert rows.select("title").distinct().count() == rows.count() == 5000
        ordered = [r["title"] for r in rows.orderBy("position").collect()]
        assert ordered == [f"t{i}" for i in range(5000)]
        counted = {r["title"]: r["seq"] for r in feeds.numbered(rows).select("title", "seq").collect()}
        assert counted == {f"t{i}": i + 1 for i in range(5000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_later_source_wins(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    out = df.select(*feeds.mapped_fields({"x": "t", "y": "t"}, F.col)).collect()
    assert [r["t"] for r in out] == ["b", "a"]


def test_raw_tags(spark, folder):
    tags = feeds.raw_tags(feeds.scan_fragments(spark, str(folder / "feed.xml")))
    got = {(r["tag"], r["value"]) for r in tags.collect()}
    assert ("Title", "Nurse") in got and ("company", "R&D Clinic") in got and ("title", "Lead <b>Nurse</b>") in got
    profile = {r["tag"]: r for r in audit.tag_profile(tags, MAPPINGS).collect()}
    assert profile["location"]["rows"] == 1 and profile["location"]["filled"] == 0
    assert profile["Title"]["target"] == "title" and not profile["other"]["is_mapped"]


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps({"mappings": {"a": "title"}, "target_mapping_options": ["title"]}))
    assert files.load_mapping(spark, str(path))["mappings"] == {"a": "title"}
    assert files.load_mapping(spark, str(tmp_path / "none.json"))["mappings"] == {}
    path.write_text("{broken")
    assert files.load_mapping(spark, str(path))["mappings"] == {}


def test_records_and_caches(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, y"\n2,z\n')
    assert [r["name"] for r in files.read_records(spark, str(tmp_path / "a.csv"), "csv").orderBy("id").collect()] == ["x, y", "z"]
    (tmp_path / "a.json").write_text('[{"id": 1, "tags": ["a", "b"]}, {"id": 2}]')
    assert files.read_records(spark, str(tmp_path / "a.json"), "json").count() == 2
    (tmp_path / "a.xml").write_text("<jobs><job><t>a</t><t>b</t></job><job><t>c</t></job></jobs>")
    xml = files.read_records(spark, str(tmp_path / "a.xml"), "xml", "t array<string>").collect()
    assert sorted(r["t"] for r in xml) == [["a", "b"], ["c"]]
    with pytest.raises(ValueError):
        files.read_records(spark, str(tmp_path), "ini")
    assert files.read_cache(spark, str(tmp_path / "none"), "k string").count() == 0
    (tmp_path / "d.json").write_text('{"hash": "h1", "eids": ["a", "b"]}\n{"hash": "h1", "eids": ["b"]}\n{"eids": ["c"]}\n')
    hashes, ids = files.deletion_keys(files.read_deletion_list(spark, str(tmp_path / "d.json")))
    assert [r["job_hash"] for r in hashes.collect()] == ["h1"]
    assert sorted(r["eid"] for r in ids.collect()) == ["a", "b", "c"]


@pytest.mark.parametrize(
    ("path", "ext", "reader"),
    [("/a/b.CSV", ".csv", "csv"), ("x.tar.gz", ".tar.gz", "archive"), ("/a.b/c", "", "unsupported"), ("f.ini", ".ini", "unsupported")],
)
def test_file_kinds(one, path, ext, reader):
    assert one(files.extension, "x string", path) == ext
    assert one(lambda x: files.reader_of(files.extension(x)), "x string", path) == reader


def test_aliases(spark):
    raw = spark.createDataFrame(
        [("r-905", "Baker", "Knead and bake.", "Oven & Sons", "1.25", "Any")],
        "requisition_id string, position_title string, job_details string, hiring_organization string, cpc string, feed_source_name string",
    )
    out = mapping.apply_aliases(raw, list(validate.POSTING_RULES))
    assert out.first().asDict() == {
        "external_job_id": "r-905", "title": "Baker", "description": "Knead and bake.", "company_name": "Oven & Sons",
    }


VALID = {
    "external_job_id": "p-17", "job_source": "JOB_FEED", "feed_id": 3, "created_at": "2021-03-02T07:15:00Z",
    "updated_at": "2021-03-02T08:45:00Z", "posted_at": "2021-03-01T06:00:00Z", "expires_at": "2021-04-30T20:00:00Z",
    "status": "ACTIVE", "company_name": "Harbour Works", "title": "Welder", "description": "text", "is_remote": False,
    "is_multi_location": True, "is_international": False, "salary_min": 38000, "extra": "ignored",
}
DDL = """external_job_id string, job_source string, feed_id int, created_at string, updated_at string, posted_at string,
    expires_at string, status string, company_name string, title string, description string, is_remote boolean,
    is_multi_location boolean, is_international boolean, salary_min int, extra string"""


def errors_of(spark, ddl=DDL, **changes):
    row = {**VALID, **changes}
    names = [part.split()[0] for part in ddl.replace("\n", " ").split(",")]
    df = spark.createDataFrame([tuple(row[n] for n in names)], ddl)
    return validate.validate(df).first()["errors"]


def test_validation(spark):
    assert errors_of(spark) == []
    assert errors_of(spark, feed_id=None) == ["Conditional error: 'feed_id' is required when 'job_source' is 'JOB_FEED'."]
    assert "must be null" in errors_of(spark, job_source="COMPANY_WEBSITE")[0]
    assert "only ['COMPANY_WEBSITE', 'JOB_FEED'] are allowed" in errors_of(spark, job_source="MAIL")[0]
    assert errors_of(spark, title=None) == ["Field 'title' cannot be null."]
    assert errors_of(spark, posted_at="yesterday") == ["Field 'posted_at' is not a valid ISO datetime string. Got: yesterday"]
    assert errors_of(spark, expires_at=None) == []
    wrong = errors_of(spark, DDL.replace("is_remote boolean", "is_remote string"), is_remote="no")
    assert wrong == ["Field 'is_remote' has incorrect type. Expected bool, got string."]


def test_missing_columns_end_the_check(spark):
    short = DDL.replace("title string, ", "")
    assert errors_of(spark, short, posted_at="yesterday") == ["Missing required field: 'title'"]
    no_feed = DDL.replace("feed_id int, ", "")
    assert errors_of(spark, no_feed) == ["Conditional error: 'feed_id' is required when 'job_source' is 'JOB_FEED'."]


def test_only_known_columns_are_loaded(spark):
    names = [part.split()[0] for part in DDL.replace("\n", " ").split(",")]
    df = spark.createDataFrame([tuple(VALID[n] for n in names)], DDL)
    out = validate.valid_rows(df)
    assert "extra" not in out.columns and out.count() == 1


def test_merge_mappings(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS o, map('b', 3, 'c', 4) AS n")
    assert df.select(mapping.merge_mappings(F.col("o"), F.col("n")).alias("m")).first()["m"] == {"a": 1, "b": 3, "c": 4}


def test_partner(one):
    assert one(mapping.partner_id, "x string", " Zip Recruiter ") == 12
    assert one(mapping.partner_id, "x string", "unknown") is None


def test_conform(spark):
    df = spark.createDataFrame([("t", "c", "FULL_TIME", "d", None)], "title string, company_name string, employment_type string, description string, salary_min double")
    row = mapping.conform(df).first()
    assert len(row) == 48
    assert row["salary_min"] is None and row["salary_max"] == 0.0
    assert row["ai_skills"] == [] and row["is_remote"] is False and row["sector_id"] is None
    assert len(row["job_hash"]) == 44


def test_migrated_feed(spark):
    row = mapping.migrate_feeds(spark.createDataFrame([("f", "http://x", 30, 2)], "name string, feed_url string, polling_interval int, error_count int")).first()
    assert row["is_active"] and row["source_url"] == "http://x" and row["company_name"] == ""
    assert row["consecutive_failure_count"] == row["error_count"] == 2 and row["avg_feed_size"] is None


def test_preview(spark):
    rows = spark.createDataFrame([("x" * 150,)] * 8, "description string")
    out = audit.preview(rows).collect()
    assert len(out) == 5 and out[0]["description"] == "x" * 100 + "..."


def test_raw_tags_keep_attributes_and_empty_elements(spark):
    fragment = '<job id="7" lang=\'en\'><title>A &amp; B</title><empty/><note kind="x"/><text><![CDATA[1 &amp; 2]]></text></job>'
    rows = spark.createDataFrame([("f", fragment)], "file_path string, fragment string")
    got = [(r["tag"], r["value"]) for r in feeds.raw_tags(rows).orderBy("pos").collect()]
    assert got == [("_id", "7"), ("_lang", "en"), ("title", "A & B"), ("empty", ""), ("note", ""), ("text", "1 &amp; 2")]


def test_fragments_are_parsed_once(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<source><job><title>A</title><url>http://x?a=1&amp;b=2</url></job></source>")
    rows = feeds.read_feed(spark, str(tmp_path), {"title": "title", "url": "apply_url"}).filter("title IS NOT NULL")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1
    assert [tuple(r) for r in rows.select("title", "apply_url").collect()] == [("A", "http://x?a=1&b=2")]


MIXED = """<?xml version="1.0"?><source>
<job id="0"><title>first</title></job>
<job><title>bare</title><job_kind>x</job_kind></job>
<job
 id="2" title="from attribute"><company>c</company></job><job></job>
<job><title><![CDATA[a < b]]></title><place><city>X</city><city>Y</city></place></job>
<job><title>broken</job>
<job id="5"><title>broken too</job>
<job id="6"><title/></job>
<job><title>cut <job id="7"><title>last</title></job></source>"""


@pytest.mark.parametrize("cut", ["<job>", "<job "])
def test_one_set_of_fragments(spark, tmp_path, cut):
    (tmp_path / "mixed.xml").write_text(MIXED, encoding="utf-8")
    path = str(tmp_path / "mixed.xml")
    if cut:
        both = feeds.scan_fragments(spark, path, attributes=True, cut=cut)
        rows = feeds.mapped_postings(feeds.parse_fragments(both, ["title", "id"], True), {"title": "title", "id": "external_job_id"}, True)
        got = [(r["external_job_id"], r["title"]) for r in rows.orderBy("position").collect()]
        assert got == [("0", "first"), (None, "bare"), ("2", "from attribute"), (None, "a < b"), ("6", None), ("7", "last")]
        assert feeds.feed_sizes(both).first()["total_in_feed"] == 7
    bare = feeds.scan_fragments(spark, path)
    assert [r["title"] for r in feeds.read_feed(spark, path, {"title": "title"}).orderBy("position").collect()] == ["bare", "a < b"]
    assert feeds.feed_sizes(bare).first()["total_in_feed"] == 3
    tags = [(r["tag"], r["value"]) for r in feeds.raw_tags(bare).orderBy("position", "pos").collect()]
    assert tags == [("title", "bare"), ("job_kind", "x"), ("title", "a < b"), ("place", ""), ("place/city", "X"), ("place/city", "Y")]


def test_prefixes_of_outer_namespaces(spark):
    rows = spark.createDataFrame([("f", '<job g:no="4"><g:id>7</g:id><time>12:30</time></job>')], "file_path string, fragment string")
    assert [(r["tag"], r["value"]) for r in feeds.raw_tags(rows).orderBy("pos").collect()] == [("_no", "4"), ("id", "7"), ("time", "12:30")]


def test_pieces_hold_all_rows_in_order_and_are_bounded():
    texts = ["a" * 30, None, "é" * 20, "", "b" * 500, "c", "d" * 99]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["n", "text"])
    pieces = list(batches.slices(batch.slice(1), "text", 100))
    assert [n for piece in pieces for n in piece.column(0).to_pylist()] == list(range(1, len(texts)))
    sizes = [[len((text or "").encode()) for text in piece.column(1).to_pylist()] for piece in pieces]
    assert all(len(piece) == 1 or sum(piece) <= 100 for piece in sizes) and len(sizes) < len(texts) - 1
    assert list(batches.slices(batch.slice(0, 0), 1, 100)) == []


def test_raw_tags_are_taken_apart_in_bounded_pieces(spark, monkeypatch):
    fragments = [f"<job><id>{i}</id><d>{'x' * 40_000}</d></job>" for i in range(100)]
    work = []
    with monkeypatch.context() as patched:
        patched.setattr(type(spark.range(1)), "mapInArrow", lambda self, fn, schema: work.append(fn) or self.selectExpr("'' AS value"))
        feeds.raw_tags(spark.createDataFrame([(fragments[0],)], "fragment string"))
    parts = list(work[0](iter([pa.RecordBatch.from_arrays([pa.array(fragments)], ["fragment"])])))
    assert sum(part.num_rows for part in parts) == 200
    assert max(part.nbytes for part in parts) < 2 * batches.SLICE_BYTES
