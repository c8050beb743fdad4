import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import SCHEMA, components, odd_documents, removed_spans, texts_by_id
from pyspark.sql import functions as F

from feedloom.llm import graph, near_duplicates, neighbours, suffix_dedup, url_filter


def near_texts():
    """A group whose members differ by a few words each, around the limit of similarity."""
    draw = random.Random(7)
    base = [f"b{k}" for k in range(120)]
    out = {}
    for i in range(60):
        own = list(base)
        for _ in range(draw.randint(0, 6)):
            own[draw.randrange(120)] = f"e{draw.randrange(40)}"
        out[1000 + i] = " ".join(own)
    return out


def test_near_duplicates_equal_all_pairs(spark):
    texts = {**texts_by_id(), **near_texts()}
    docs = odd_documents(spark).select("doc_id", "text", "lang").union(spark.createDataFrame([(i, t, "n") for i, t in near_texts().items()], "doc_id long, text string, lang string"))
    wanted, sets = components(texts, 85)
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(docs).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), wanted[i], wanted[i] == i) for i in texts}


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """Small blocks and a hub round before every comparison give the same components."""
    monkeypatch.setattr(near_duplicates, "PAIRS_PER_ROW", 0)
    monkeypatch.setattr(near_duplicates._across, "__defaults__", (8,))
    texts = near_texts()
    wanted, _ = components(texts, 85)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == wanted


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.9):
        common = draw.integers(0, 1 << 63, int(1000 * share)).astype(np.uint64)
        rest = [draw.integers(0, 1 << 63, 1000 - len(common)).astype(np.uint64) for _ in range(2)]
        row = np.repeat([0, 1, 2], [1000, 1000, 3])
        found = np.concatenate([common, rest[0], common, rest[1], common[:3]])
        sketch = near_duplicates.sketches(row, found, 4, 400)
        assert (sketch[:3] != near_duplicates.ALL).all() and (sketch[3] == near_duplicates.ALL).all()
        true = len(common) / (2000 - len(common))
        assert abs((sketch[0] == sketch[1]).mean() - true) < 0.1


def test_components_in_many_tasks(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50) if i % 10 != 9], "a long, b long").repartition(8)
    for most in (1_000_000, 10):
        assert {r.id: r.component for r in graph.components(edges, most).collect()} == {i: i // 10 * 10 for i in range(50)}


@pytest.mark.parametrize("group_rows", [1_000_000, 1])
def test_removed_bytes_equal_all_windows(spark, group_rows):
    """Both ways, by suffix arrays and by windows of hot anchors, remove the same bytes."""
    draw = random.Random(11)
    vocabulary = [f"t{k}" for k in range(30)]
    texts = texts_by_id()
    shared = " ".join(draw.choice(vocabulary) for _ in range(60))
    for i in range(100, 140):
        own = [draw.choice(vocabulary) for _ in range(50)]
        cut = draw.randrange(len(shared) // 2)
        texts[i] = " ".join(own[:25]) + shared[cut : cut + draw.randrange(90, 180)] + " ".join(own[25:]) + "ü" * draw.randrange(3)
    docs = spark.createDataFrame([*texts.items(), (100, texts[100]), (None, shared)], "doc_id long, text string").withColumn("start", F.lit(1))
    masks = removed_spans(texts)
    got = {r.doc_id: r for r in suffix_dedup.digest(docs, group_rows).collect()}
    assert set(got) == set(texts)
    for name, text in texts.items():
        data, mask = text.encode(), masks[name]
        kept = bytes(b for b, m in zip(data, mask) if not m)
        runs = sum(m and (k == 0 or not mask[k - 1]) for k, m in enumerate(mask))
        assert (got[name].n_bytes, got[name].n_removed, got[name].n_spans) == (len(data), sum(mask), runs)
        assert got[name].kept_sha256 == hashlib.sha256(kept).hexdigest()
    left = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, group_rows).collect()}
    whole = {n: bytes(b for b, m in zip(t.encode(), masks[n]) if not m).decode("utf-8", "ignore") for n, t in texts.items()}
    assert left == whole


def test_one_document_makes_an_anchor_hot(spark):
    """100,000 varied occurrences in one document are no group that one task sorts."""
    draw = random.Random(9)
    stamp = lambda: f"{draw.randrange(10**12):012d}"
    fixed = "status=served upstream=primary bytes=4096 cache=miss agent=crawler zone=west "
    text = "".join(fixed + stamp() for _ in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "z" * 50 + text[:300])], "doc_id long, text string")
    found = suffix_dedup.anchor_rows(docs)
    assert found.agg(F.max("n")).first()[0] > 50_000
    hot = suffix_dedup.repeated_anchors(found).groupBy("doc_id").agg(F.collect_list("x").alias("hs"))
    frames = suffix_dedup.frames(docs.join(hot, "doc_id").select("doc_id", "text", "hs")).groupBy("kind", "h").count()
    assert (frames.filter("kind = 0").agg(F.max("count")).first()[0] or 0) <= suffix_dedup.GROUP_ROWS
    got = {r.doc_id: r for r in suffix_dedup.digest(docs).collect()}
    # the windows of 100 bytes that repeat, counted plainly
    windows, mask = {}, np.zeros(len(text), bool)
    for i in range(len(text) - 99):
        if windows.setdefault(text[i : i + 100], i) != i:
            mask[i : i + 100] = True
    assert (got[1].n_removed, got[2].n_removed) == (int(mask.sum()), 300)


def test_maximal_repeats_have_all_occurrences():
    """Every repeat of a group is found with all its places, and no longer one holds the same places."""
    left = ["xab", "yab", "ab", "zzz"]
    right = ["g" * 24 + s for s in ("tail" * 19, "tail" * 19, "tail" * 10 + "q" * 36, "tail" * 19)]
    group = near = suffix_dedup.frame_repeats(
        np.zeros(4, np.int64), np.arange(4), np.full(4, 50),
        pa.array([("p" * 70 + x)[::-1].encode() for x in left], pa.binary()), pa.array([r.encode() for r in right], pa.binary()),
    )
    numbers, rows, before, after, first = near
    found = {(int(b), int(a)): frozenset(rows[(numbers == n)].tolist()) for n, b, a in zip(*group[:1], before, after)}
    assert found[(0, 100)] == {0, 1, 3} and found[(2, 100)] == {0, 1}
    assert (first[numbers == numbers[0]] == min(rows[numbers == numbers[0]])).all()


def test_nothing_to_remove(spark):
    assert suffix_dedup.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    got = suffix_dedup.digest(spark.createDataFrame([(1, "short"), (2, "short")], "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_neighbours_against_all_pairs(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(20, 16))
    vectors = np.concatenate([centres[k % 20] + 0.3 * draw.normal(size=(1, 16)) for k in range(600)])
    vectors[100:160] = vectors[100]
    rows = [(i, [float(np.float32(x)) for x in v], 0.5) for i, v in enumerate(vectors)]
    bad = [(900, None, 0.0), (920, [0.0] * 16, 0.0), (940, [float("nan")] * 16, 0.0), (960, [None] * 16, 0.0), (980, [1.0] * 3, 0.0), (None, rows[0][1], 0.0), rows[20]]
    docs = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score double")
    got = {}
    for r in neighbours.nearest(docs, F.col("vec_id") % 20 == 0, k=5, block_rows=100, query_rows=7, sample_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    exact = np.array([r[1] for r in rows])
    assert set(got) == set(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        scores = exact @ exact[q]
        order = [int(i) for i in np.lexsort((np.arange(600), -scores.round(12))) if i != q][:5]
        assert len(found) == 5 and all(abs(scores[v] - s) < 1e-9 for v, s in found)
        hits += len(set(order) & {v for v, _ in found})
    assert hits / (5 * len(got)) >= 0.9
    assert [v for v, _ in got[100]] == [101, 102, 103, 104, 105] or len({round(s, 9) for _, s in got[100]}) > 1
    assert neighbours.nearest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["lengths", "offset", "few", "skewed"])
def test_neighbours_of_other_vectors(spark, kind):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(1200, 4 if kind == "few" else 24))
    if kind == "lengths":
        vectors *= np.exp(draw.normal(size=(1200, 1)))
    if kind == "offset":
        vectors += 4
    if kind == "skewed":
        vectors *= 0.7 ** np.arange(24)
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    joined = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = neighbours.nearest(docs, F.col("vec_id") % 20 == 0, k=10, block_rows=300, query_rows=20, sample_rows=400).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
    hits = 0
    for q in range(0, 1200, 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        found = {r.vec_id for r in got if r.query_id == q}
        assert len(found) == 10
        hits += len(found & set(np.argsort(-scores, kind="stable")[:10].tolist()))
    assert hits / 600 >= 0.9


def test_every_code_within_the_radius():
    draw = np.random.default_rng(6)
    codes = draw.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 1, 2, 3, 5, 11, 20, 27, 64):
        code = codes[7] ^ np.array([1, 0, 2, 0], np.uint16)
        wanted = np.flatnonzero(np.bitwise_count(codes ^ code).sum(axis=1) <= radius)
        assert index.within(code, radius).tolist() == wanted.tolist()


def test_url_rules_and_trees(spark):
    urls = [
        (1, "http://a.NET/x"), (2, "https://www.example.net/en/1?q=2"), (3, "http://example.com/de/"), (4, "http://x.org/fr/2#a"),
        (5, "http://evilnet/x"), (6, "http://a.net?x=/"), (7, None), (8, "no url"), (9, ""), (10, "http://example.org/en/1"), (1, "http://a.NET/x"), (None, "http://q.net/"),
    ]
    urls += [(100 + i, f"http://h{i}.net/p{i}?a={i}") for i in range(60)] + [(200 + i, f"http://h{i}.org/fr/{i}") for i in range(60)]
    got = url_filter.verdicts(spark.createDataFrame(urls, "page_id long, url string").withColumn("rule", F.lit("clash"))).collect()
    assert len(got) == len(urls)
    by_id = {r.page_id: r for r in got}
    assert (by_id[1].host, by_id[1].path, by_id[1].rule, by_id[1].verdict) == ("a.net", "/x", "net/", "block")
    assert (by_id[2].rule, by_id[2].verdict) == ("example.net/en/", "allow")
    assert (by_id[3].rule, by_id[4].rule) == ("example.com/de/", "org/fr/")
    assert by_id[5].rule is None and by_id[6].rule is None and by_id[6].path == ""
    assert (by_id[7].host, by_id[7].path, by_id[8].host, by_id[9].rule) == ("", "", "", None)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert url_filter.verdicts(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_copies_of_a_url_come_as_one_weighted_row(spark, monkeypatch):
    """Whichever URL a third of the labelled rows holds, the sample has it once and stays bounded."""
    seen = []
    fit_trees = url_filter.fit_trees
    monkeypatch.setattr(url_filter, "fit_trees", lambda x, y, weights: seen.append((len(x), weights)) or fit_trees(x, y, weights=weights))
    urls = [f"http://h{i}.net/a" if i % 2 else f"http://example.net/en/{i}" for i in range(600)]
    for hot in urls[:6]:
        rows = spark.createDataFrame([(u, u.split("/")[2], "/" + u.split("/", 3)[3], int(u.endswith("a"))) for u in urls + [hot] * 300], "url string, host string, path string, label int")
        model, _ = url_filter.fit(rows, sample_rows=60)
        size, weights = seen.pop()
        assert model is not None and 20 < size < 120
        assert sorted(weights)[-2:] == [1.0, pytest.approx(30.1)]


def test_trees_learn_what_features_tell():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = url_filter.fit_trees(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == (y[1500:] == 1)).mean() > 0.95
