import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_cases import LOWER, SCHEMA, odd_documents, rows

from feedloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, best=10):
    """Every document scored for every item; ``docs`` is a list of (id, text)."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, total = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = set()
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    for item, wanted in asked.items():
        scores = []
        for doc, counts, n in found:
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in wanted if counts[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out |= {(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scores)[:best])}
    return out


def searched(docs, items, **how):
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **how).collect()), key=str)


ITEMS = [(1, "word7 and some MORE text", 5), (2, None, 5), (3, " \t", 5), (4, "größe la x 123 日本語", 5), (None, "word1", 5), (4, "teksuto テキスト", 6), (7, "the and of it", 7)]


def test_odd_documents_and_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string, rank int")
    wanted = brute_force([(r[0], r[1]) for r in rows()], [i[:2] for i in ITEMS])
    assert searched(odd_documents(spark).repartition(3), items) == sorted(wanted, key=str)
    assert searched(odd_documents(spark), items, best=2) == sorted(brute_force([(r[0], r[1]) for r in rows()], [i[:2] for i in ITEMS], 2), key=str)


@pytest.mark.parametrize("owners, bundle, shard", [(1, 64, 4096), (4, 3, 40), (7, 1, 7)])
def test_many_shards_equal_brute_force(spark, monkeypatch, owners, bundle, shard):
    monkeypatch.setattr(ranked_search, "SHARD_DOCUMENTS", shard)
    draw = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(draw.choices(words, weights, k=draw.randint(1, 60)))) for k in range(500)]
    docs += [(500 + k, docs[3][1]) for k in range(150)]  # copies tie
    items = [(k, " ".join(draw.choices(words, k=6))) for k in range(20)]
    got = searched(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string"), owners=owners, bundle=bundle)
    assert got == sorted(brute_force(docs, items), key=str)


def test_accumulators_that_cannot_win_are_left_behind(spark):
    """A common term behind a rare one opens no accumulators once ten documents are out of reach."""
    docs = [(k, "rare rare2 common") if k < 12 else (k, "common and so on") for k in range(400)]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "rare rare2 common")], "item_id long, text string")
    assert searched(table, items) == sorted(brute_force(docs, [(1, "rare rare2 common")]), key=str)
    state = spark.createDataFrame([(0, 0, 1, 0, b"", b"")], ranked_search.STATE)
    bundled = spark.createDataFrame([(0, 1, [("rare", 3000, 0), ("common", 10, 1)])], "bundle long, item_id long, terms array<struct<term string, w long, owner int>>")

    def owned(term, n):
        places, ones = np.arange(n, dtype="<i4").tobytes(), np.ones(n, "<i4").tobytes()
        return spark.createDataFrame([(0, 0, term, places, ones, np.full(n, 3, "<i8").tobytes())], "shard long, bundle long, term string, places binary, counts binary, lengths binary")

    first = spark.createDataFrame(ranked_search.visit(state, owned("rare", 12), bundled, 0, 400, 1200, 10).collect(), ranked_search.STATE)
    last = ranked_search.visit(first, owned("common", 400), bundled, 1, 400, 1200, 10).first()
    assert len(np.frombuffer(last.places, "<i4")) == 12


def test_terms_stop_at_row_limits():
    data = np.frombuffer("ab cd,efgh ü9".encode(), np.uint8)
    starts, ends = ranked_search.terms_of(data, np.array([0, 4, 8, len(data)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "c", "d", "ef", "gh", "ü9"]


def test_empty_tables(spark):
    docs, items = odd_documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string, rank int")
    assert searched(spark.createDataFrame([], SCHEMA), items) == []
    assert searched(docs, items.limit(0)) == []
    assert searched(docs.filter("text IS NULL"), items) == []
