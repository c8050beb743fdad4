import base64
import hashlib
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.functions import dates, hashing, places, similarity, text


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""),
        ("<p>Hello,  World!</p>", "hello world"),
        ("See https://a.b/c?d=1 now", "see now"),
        ("A B\t\nC", "a b c"),
        ("Ünïcode 12", "n code 12"),
    ],
)
def test_clean_for_hash(one, raw, want):
    assert one(text.clean_for_hash, "x string", raw) == want


def test_strip_knows_unicode_space(one):
    assert one(text.strip, "x string", "  \ttitle \n") == "title"


def test_clean_html_keeps_tags_broken_over_lines(one):
    assert one(text.clean_html, "x string", "<b>a</b> <i\n>b") == "a <i >b"
    assert one(text.clean_html, "x string", None) == ""


def test_excerpt_and_ellipsis(one):
    assert one(lambda x: text.plain_excerpt(x, 5), "x string", "<p>ab  cdefg</p>") == "ab cd"
    assert one(lambda x: text.ellipsis(x, 3), "x string", "abcd") == "abc..."
    assert one(lambda x: text.ellipsis(x, 3), "x string", "abc") == "abc"


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Full-Time", "FULL_TIME"), ("fulltime", "FULL_TIME"), ("Full time, nights", "PART_TIME"), (None, "PART_TIME")],
)
def test_employment_type(one, raw, want):
    assert one(text.employment_type, "x string", raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Position FILLED", "CLOSED"), ("inactive", "CLOSED"), ("not available", "CLOSED"), ("open", "ACTIVE"), (None, "ACTIVE")],
)
def test_status(one, raw, want):
    assert one(text.posting_status, "x string", raw) == want


def test_truth_and_number(one):
    assert one(text.truth, "x string", "YES") is True
    assert one(text.truth, "x string", "no") is False
    assert one(text.number, "x string", "12.5") == 12.5
    assert one(text.number, "x string", "n/a") is None
    assert one(lambda x: text.number(x, 0.0), "x string", None) == 0.0


def test_entities(one):
    assert one(text.unescape_entities, "x string", "R&amp;D &#39;x&#39; &copy; 5") == "R&D 'x' © 5"
    assert one(text.unescape_entities, "x string", None) is None
    assert one(text.unescape_web_address, "x string", "https://a?b=1&amp;c=2") == "https://a?b=1&c=2"
    assert one(text.unescape_web_address, "x string", "a &amp; b") == "a &amp; b"


def test_repair_xml(one):
    assert one(text.repair_xml, "x string", "a & b &amp; &#39; \x00c") == "a &amp; b &amp; &amp;#39; c"


def reference_hash(title, company, kind, cleaned):
    return base64.b64encode(hashlib.sha256(f"{title}|{company}|{kind}|{cleaned}".encode()).digest()).decode()


def test_hash_ignores_place_id_and_address(spark):
    rows = [
        ("1", "Engineer ", "Innovatech", "<b>Build</b> services", "FULL_TIME", "Boston"),
        ("2", "Engineer", "Innovatech", "Build   services!", "Full time", "New York"),
        ("3", "Analyst", "Innovatech", "Build services", None, "Boston"),
    ]
    df = spark.createDataFrame(rows, "id string, title string, company_name string, description string, employment_type string, place string")
    a, b, c = [r["h"] for r in df.select("id", hashing.canonical_hash().alias("h")).orderBy("id").collect()]
    assert a == b == reference_hash("Engineer", "Innovatech", "FULL_TIME", "build services")
    assert c == reference_hash("Analyst", "Innovatech", "PART_TIME", "build services")


def test_json_hash(spark):
    df = spark.createDataFrame(
        [("Zoë \"Q\"", "Düse\n", None, "x")], "title string, company_name string, employment_type string, description string"
    )
    want = json.dumps(
        {"company_name": "Düse\n", "description": "x", "employment_type": None, "title": "Zoë \"Q\""}, separators=(",", ":")
    )
    got = df.select(hashing.json_hash().alias("h")).first()["h"]
    assert got == base64.b64encode(hashlib.sha256(want.encode()).digest()).decode()


def locs(rows):
    return [tuple(r) for r in rows]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, [(None, None, "US")]),
        ("", [(None, None, "US")]),
        ("Boston", [("Boston", None, "US")]),
        ("Seattle, WA", [("Seattle", "WA", "US")]),
        ("Boston, MA, United States of America", [("Boston", "MA", "US")]),
        ("Paris, IDF, France", [("Paris", "IDF", "France")]),
        ("a, b, c, d", [(None, None, "US")]),
    ],
)
def test_locations_from_text(one, raw, want):
    assert locs(one(places.locations_from_text, "x string", raw)) == want


def test_locations_from_structs(one):
    ddl = f"x array<{places.LOCATION}>"
    assert locs(one(places.locations_from_structs, ddl, [("Boston", None, "USA"), (None, "BC", "Canada")])) == [
        ("Boston", None, "US"), (None, "BC", "Canada"),
    ]
    assert locs(one(places.locations_from_structs, ddl, None)) == [(None, None, "US")]


def test_locations_from_columns_keep_their_meaning(one):
    got = one(places.locations_from_columns, "a string, b string, c string, d string", None, "TX", "USA", "ignored")
    assert locs(got) == [(None, "TX", "US")]


@pytest.mark.parametrize(
    ("value", "query", "shown"),
    [
        ([("Boston", "MA", "US")], "Boston, MA, US", "Boston MA US"),
        ([("Boston", "MA", "US"), ("Salem", "MA", "US")], "MA, US", "Boston MA US, Salem MA US"),
        ([("Boston", "MA", "US"), ("Reno", "NV", "US")], "US", "Boston MA US, Reno NV US"),
        ([(None, None, "US")], "US", "US"),
        ([], None, ""),
        (None, None, ""),
    ],
)
def test_location_texts(one, value, query, shown):
    ddl = f"x array<{places.LOCATION}>"
    assert one(places.geo_query, ddl, value) == query
    assert one(places.location_string, ddl, value) == shown


def test_wkt(one):
    assert one(places.wkt_point, "x struct<lat:double,lng:double>", (1.5, -2.25)) == "POINT(-2.25 1.5)"
    assert one(places.wkt_point, "x struct<lat:double,lng:double>", None) is None


def test_location_mentions_go(one):
    raw = "Nurse based in Boston, MA - 02110, USA. Nights"
    assert one(places.remove_location_mentions, "x string", raw) == "nurse . nights"
    # the code may be any word, as case is ignored
    assert one(places.remove_location_mentions, "x string", "We work in a fast team of people who care, and ship.") == "we ship."


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2024-03-01T10:20:30Z", "2024-03-01 10:20:30"),
        ("2024-03-01T10:20:30+05:00", "2024-03-01 10:20:30"),
        ("Fri, 01 Mar 2024 10:20:30 GMT", "2024-03-01 10:20:30"),
        ("3/1/2024", "2024-03-01 00:00:00"),
        ("2024-03-01", "2024-03-01 00:00:00"),
        ("soon", None),
        ("2024-13-45", None),
        (None, None),
    ],
)
def test_naive_timestamp(one, raw, want):
    got = one(dates.naive_timestamp, "x string", raw)
    assert (str(got) if got else None) == want


def test_instants(one):
    assert one(dates.warehouse_timestamp, "x string", "2024-03-01T10:20:30+05:00") == "2024-03-01T05:20:30+00:00"
    assert one(dates.warehouse_timestamp, "x string", "2024-03-01") == "2024-03-01T00:00:00+00:00"
    assert one(dates.epoch_millis, "x string", "1970-01-02T00:00:00Z") == 86_400_000
    assert one(dates.epoch_millis, "x string", "garbage") == 0
    assert one(dates.epoch_number_to_millis, "x double", 1.7e9) == 1_700_000_000_000
    assert one(dates.epoch_number_to_millis, "x double", 1.7e12) == 1_700_000_000_000
    assert one(dates.epoch_number_to_millis, "x double", None) == 0
    assert one(dates.is_iso, "x string", "2024-03-01T10:20:30Z") is True
    assert one(dates.is_iso, "x string", "03/01/2024") is False
    assert one(dates.is_iso, "x string", None) is False


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = last + 1 if x == y else max(row[j], row[j - 1])
            last = keep
    return row[-1]


@given(st.text("abc ", max_size=40), st.text("abc ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_common_subsequence(a, b):
    assert similarity.common_subsequence(a, b) == plain_lcs(a, b)


@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30), st.sampled_from([0.5, 0.7, 0.85]))
@settings(max_examples=300, deadline=None)
def test_ratio_bound_never_loses_a_match(a, b, limit):
    exact = 1.0 if not a + b else 2 * plain_lcs(a, b) / len(a + b)
    bounded = similarity.indel_ratio(a, b, limit)
    assert bounded == exact if exact >= limit else bounded < limit


def test_ratio_by_hand():
    assert similarity.indel_ratio("abcd", "abed") == 0.75
    assert similarity.indel_ratio("", "") == 1.0
    assert similarity.indel_ratio("", "a") == 0.0


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85, 1.0])
@pytest.mark.parametrize("n", [0, 1, 64, 65, 300])
def test_long_subsequences_are_the_common_ones(share, n):
    rng = random.Random(n)
    text = "".join(rng.choice("abc é") for _ in range(n))

    def changed(rate):
        kept = (c if rng.random() > rate else rng.choice(["", "x", c + "b"]) for c in text)
        return "".join(kept)

    others = [changed(rate) for rate in (0, 0.05, 0.1, 0.2, 0.3, 0.5)] + ["", "x", text + text, text[: n // 2]]
    parts, counts = similarity.codes([text, *others])
    assert [int(c.sum()) for c in counts] == [len(text), *map(len, others)]
    least = np.array([math.ceil(share * (n + len(other)) / 2 - 1e-9) for other in others])
    want = [similarity.common_subsequence(other, text) for other in others]
    for pack in (1, 4, 64):
        got = similarity.long_subsequences(parts[0], parts[1:], least, pack)
        assert got.tolist() == [length if length >= low else 0 for length, low in zip(want, least)]


def test_words(one):
    assert one(similarity.sorted_words, "x string", "b a c a") == "a a b c"
    assert one(similarity.sorted_words, "x string", "") == ""
    assert one(lambda a, b: similarity.jaccard(similarity.word_set(a), similarity.word_set(b)), "a string, b string", "a b c", "b c d") == 0.5
    assert one(lambda a, b: similarity.jaccard(similarity.word_set(a), similarity.word_set(b)), "a string, b string", "", "") == 0.0


def test_block_key(one):
    ddl = "a string, b string, c string, d string"
    assert one(similarity.block_key, ddl, " Title ", "ACME", None, None) == "title|acme|"
    assert one(similarity.block_key, ddl, "Title", "ACME", "x", "Better") == "better|acme|x"
    assert one(similarity.block_key, ddl, "Title", "ACME", "x", "") == "title|acme|x"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Tue, 02 Jan 2024 10:00:00 +0200", "2024-01-02T08:00:00+00:00"), ("Tue, 02 Jan 2024 10:00:00 -0130", "2024-01-02T11:30:00+00:00"),
        ("02 Jan 2024 10:00:00 GMT", "2024-01-02T10:00:00+00:00"), ("2024-01-02T10:00:00.1234567Z", "2024-01-02T10:00:00+00:00"),
        ("January 2, 2024", "2024-01-02T00:00:00+00:00"), ("2024/01/02", "2024-01-02T00:00:00+00:00"),
        ("02-Jan-2024", "2024-01-02T00:00:00+00:00"), ("20240102", "2024-01-02T00:00:00+00:00"), ("2024-99-99", None), ("12345678901", None),
    ],
)
def test_warehouse_timestamps(one, raw, want):
    assert one(dates.warehouse_timestamp, "x string", raw) == want


@pytest.mark.parametrize("raw, want", [("12d", None), ("12f", None), ("0x1p3", None), (" -1.5e3 ", -1500.0), (".5", 0.5), ("7.", 7.0), ("", None)])
def test_numbers_are_decimal(one, raw, want):
    assert one(text.number, "x string", raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("02 January 2024", "2024-01-02 00:00:00"),
        ("2024/1/2 03:04", "2024-01-02 03:04:00"),
        ("2024-01-02 10:00:00 PM", "2024-01-02 22:00:00"),
        ("January 2nd, 2024 at 3pm", "2024-01-02 15:00:00"),
        ("Tue, Jan 2 2024 12:05 a.m.", "2024-01-02 00:05:00"),
        ("Tuesday 2 January 2024 12:05 PM", "2024-01-02 12:05:00"),
        ("2 Jan 24", "2024-01-02 00:00:00"),
        ("2024 Sept 30", "2024-09-30 00:00:00"),
        ("30-Sep-1999 23:59:59", "1999-09-30 23:59:59"),
        ("1/2/24", "2024-01-02 00:00:00"),
        ("13/2/2024", "2024-02-13 00:00:00"),
        ("1.2.2024 7:08", "2024-01-02 07:08:00"),
        ("2024.12.31", "2024-12-31 00:00:00"),
        ("2024/31/12", "2024-12-31 00:00:00"),
        ("5/6/80", "1980-05-06 00:00:00"),
        ("2024/1/2T03:04:05.5", "2024-01-02 03:04:05.5"),
        ("March 5, 2024 10:00:00 EST", "2024-03-05 10:00:00"),
        ("5 March 2024 10:00 +0200", "2024-03-05 10:00:00"),
        ("Dec 25th of 2023", "2023-12-25 00:00:00"),
        ("MAY 1 2024", "2024-05-01 00:00:00"),
        ("2024-2-30", None),
        ("30 February 2024", None),
        ("January 2024", None),
        ("Jan 2 Feb 2024", None),
        ("13 pm 1/2/2024", None),
        ("2024-01-02 10:61", None),
        ("1 2 3 4", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_dates_by_tokens(one, raw, want):
    got = one(dates.naive_timestamp, "x string", raw)
    assert (None if got is None else str(got).removesuffix("00000") if got.microsecond else str(got)) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("5 March 2024 10:00 +0200", "2024-03-05T08:00:00+00:00"),
        ("March 5th, 2024 10:30 pm -05:30", "2024-03-06T04:00:00+00:00"),
        ("2024/3/5 10:00 UTC", "2024-03-05T10:00:00+00:00"),
    ],
)
def test_instants_by_tokens(one, raw, want):
    assert one(dates.warehouse_timestamp, "x string", raw) == want
