import random
import zlib
from collections import defaultdict

import numpy as np
from corpus_cases import SCHEMA, odd_documents, rows
from tokenizers import Tokenizer

from feedloom.llm import packing


def test_ids_equal_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = [r[1] or "" for r in rows()] + ["L'été ΣΑΣ don't x<|endoftext|> y", "\x1c á é Ⅻ ½"]
    for text, found in zip(texts, packing.token_ids(packing.default_tokenizer()).encode([t.encode() for t in texts])):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_piece_has_its_place(spark):
    got = packing.pack_documents(odd_documents(spark), limit=64, with_ids=True, open_bins=4).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    wanted = []
    for r in rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            wanted.append((r[0], k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    key = lambda t: tuple(str(x) for x in t)
    assert sorted([tuple(r[:6]) for r in got], key=key) == sorted(wanted, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_bins_equal_a_plain_best_fit():
    draw = random.Random(3)
    bins, plain, names = packing.OpenBins(50, 5), [], 0
    for _ in range(2000):
        n = draw.randint(1, 50)
        fitting = [b for b in plain if b[0] >= n]
        if fitting:
            free = min(b[0] for b in fitting)
            chosen = [b for b in plain if b[0] == free]
            place = bins.place(n)
            assert place[1] == 50 - free and place[0] in [b[1] for b in chosen]
            mine = next(b for b in chosen if b[1] == place[0])
            mine[0] -= n
        else:
            assert bins.place(n) == (names, 0)
            if n < 50 and len(plain) == 5:
                least = min(b[0] for b in plain)
                gone = [b for b in plain if b[0] == least]
                open_now = {x for free in bins.by_free for x in free}
                plain.remove(next(b for b in gone if b[1] not in open_now))
            plain.append([50 - n, names])
            names += 1
        plain = [b for b in plain if b[0]]
    assert bins.count == len(plain)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
