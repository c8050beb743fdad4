import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from corpus_cases import LOWER, SCHEMA, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import spelling_variants
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    """Words and their numbers of occurrences, ``docs`` is a list of (id, text)."""
    out = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                gone = h % len(run)
                run = run[:gone] + run[gone + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def grouped(counts):
    """Rows of the result by the patterns that one letter less leaves, an exact plain way to all near words."""
    masks = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            masks[w[:k] + "*" + w[k + 1 :]].add(w)
            masks[w[:k] + w[k + 1 :]].add(w)
        masks[w].add(w)
    form, near = {}, {}
    for w in counts:
        found = {x for k in range(len(w)) for x in masks[w[:k] + "*" + w[k + 1 :]]}
        found |= {x for x in masks[w] if len(x) == len(w) + 1}
        found |= {x for k in range(len(w)) for x in masks.get(w[:k] + w[k + 1 :], ()) if len(x) == len(w) - 1}
        found.discard(w)
        near[w] = found
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def result(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_plain_version_equals_all_pairs():
    words = ["abcdefg", "abcdefh", "abcdef", "abcdefgh", "aabcdefg", "bacdefg", "gfedcba", "àbcdefg"]
    near = {w: sum(is_near(w, x) for x in words) for w in words}
    assert {r[0]: r[4] for r in grouped(dict.fromkeys(words, 2))} == near


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abcàÿ×", min_size=1, max_size=6), min_size=1, max_size=60, unique=True), st.integers(0, 2**16))
def test_cell_equals_all_pairs(words, seed):
    words = sorted(words)
    draw = random.Random(seed)
    n = np.array([draw.randint(1, 4) for _ in words])
    owned = np.array([draw.random() < 0.7 for _ in words])
    found, best, who = spelling_variants.cell_neighbours(words, n, owned)
    for k, w in enumerate(words):
        near = [j for j, x in enumerate(words) if owned[j] and is_near(w, x)]
        wanted = min(near, key=lambda j: (-n[j], j), default=-1)
        assert (found[k], who[k]) == (len(near), wanted)


def test_checksums_equal_zlib():
    data = np.frombuffer(("ab" * 80 + "xyzäöü").encode(), np.uint8)
    starts, ends = np.array([0, 3, 5, 0, 160, 7]), np.array([1, 9, 5, 160, 169, 80])
    begun = np.array([zlib.crc32(f"{k}:".encode()) for k in range(6)], np.uint32)
    wanted = [zlib.crc32(data[a:b].tobytes(), int(p)) for a, b, p in zip(starts, ends, begun)]
    assert spelling_variants.crcs(data, starts, ends, begun).tolist() == wanted


def test_cells_reach_every_near_word():
    draw = random.Random(5)
    words = sorted({"".join(draw.choices("abcdefghijé", k=draw.randint(7, 9))) for _ in range(2000)})
    words = sorted({*words, *[w[:3] + draw.choice("abcdé") + w[4:] for w in words], *[w[:2] + w[3:] for w in words]})
    counts = spelling_variants.vectors(words)
    groups = spelling_variants.letter_groups(counts)
    sums = spelling_variants.grouped(counts, groups)
    cells = spelling_variants.Cells(sums, 40)
    assert cells.cells > 20
    row, cell = cells.reached(sums)
    home = dict(zip(*(x.tolist() for x in cells.reached(sums, 0, 0))))
    reached = defaultdict(set)
    for r, c in zip(row.tolist(), cell.tolist()):
        reached[r].add(c)
    assert len(home) == len(words)
    place = {w: k for k, w in enumerate(words)}
    for w, k in place.items():
        for x in [w[:3] + c + w[4:] for c in "abcdé"] + [w[:j] + w[j + 1 :] for j in range(len(w))]:
            if x in place:
                assert home[place[x]] in reached[k] and home[k] in reached[place[x]]


def test_odd_documents(spark):
    texts = [(r[0], r[1]) for r in rows()]
    got = result(spelling_variants.variants(odd_documents(spark).repartition(3)))
    assert got == grouped(counted(texts))


def test_chains_ties_and_anagrams_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "SAMPLE_CELL", 2)
    draw = random.Random(11)
    base = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(7, 12))) for _ in range(120)]
    texts = []
    for k, w in enumerate(base):
        texts += [w] * draw.choice([2, 25, 300])
        texts += [w[:4] + draw.choice("abxyz") + w[5:]] * draw.choice([2, 3, 30])
        texts += ["".join(draw.sample(w, len(w)))] * 2 + [w + "s"] * 2 + [w[1:]] * 2 + [w[:3] + "é" + w[3:]] * 2
    for w in base[:10]:
        near = w[:4] + "z" + w[5:]
        texts += [w] * 600 + [near] * 40 + [near + "y"] * 2
    texts += ["x" * 4000] * 40 + ["x" * 3999] * 3 + ["×" * 8] * 20 + ["×" * 7 + "÷"] * 2
    draw.shuffle(texts)
    docs = [(k, " ".join(texts[k * 100 : k * 100 + 100])) for k in range(len(texts) // 100 + 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = grouped(counted(docs))
    assert any(r[2] not in (r[0], r[1]) for r in wanted)  # a chain of two forms
    assert result(spelling_variants.variants(table, sample=300, cell_words=40)) == wanted


def test_empty_tables(spark):
    assert spelling_variants.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling_variants.variants(odd_documents(spark).filter("text IS NULL")).collect() == []


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(QUERIES["op13_spelling_variants"](spark, SF)) == grouped(counted(docs))
