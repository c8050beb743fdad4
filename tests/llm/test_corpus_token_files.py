import json
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import SCHEMA, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import packing, token_files
from feedloom.llm.queries import QUERIES


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40), st.integers(0, 2200), st.integers(0, 33), st.integers(0, 100))
def test_blocks_round_trip(outliers, n, bits, percent):
    draw = np.random.default_rng(n)
    ids = draw.integers(0, 2**bits, n).astype(np.uint32) if bits < 33 else np.full(n, 7, np.uint32)
    ids = np.concatenate([ids, np.array(outliers, np.uint32)])
    draw.shuffle(ids)
    blocks = token_files.encode_blocks(ids, percent)
    assert len(blocks) == -(-len(ids) // token_files.BLOCK)
    data = b"".join(blocks)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert token_files.decode_blocks(data, starts)[: len(ids)].tolist() == ids.tolist()


@pytest.mark.parametrize("width", range(0, 33))
def test_packed_words_equal_a_plain_bit_string(width):
    values = np.random.default_rng(width).integers(0, 2**width, (3, token_files.BLOCK)).astype(np.uint64)
    words = token_files.pack(values, width)
    assert words.shape == (3, width * token_files.COLUMNS)
    for block, found in zip(values.reshape(3, token_files.ROWS, -1), words.reshape(3, width, token_files.COLUMNS)):
        for column in (0, 7, 15):
            bits = sum(int(v) << (width * r) for r, v in enumerate(block[:, column]))
            assert [(bits >> 64 * w) & (2**64 - 1) for w in range(width)] == [int(x) for x in found[:, column]]
    assert (token_files.unpack(words, width) == values).all()


def test_width_and_exceptions():
    ids = np.arange(1024, dtype=np.uint32) % 16 + 1000
    ids[::20] += 2**20
    low, width, _, extra = struct.unpack_from(token_files.HEAD, token_files.encode_blocks(ids, 90)[0])
    assert (low, width, extra) == (1000, 4, 52)
    assert struct.unpack_from(token_files.HEAD, token_files.encode_blocks(ids, 100)[0])[1::2] == (21, 0)


def expected():
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    found = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows()]
    found.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc, ids in found:
        out.append((doc, start, len(ids), ids))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    token_files.write_documents(odd_documents(spark).repartition(5), path)
    wanted = expected()
    by_start = lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])
    got = by_start(token_files.read_ids(spark, path))
    assert [r[0] for r in got] == [r[0] for r in wanted]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert by_start(token_files.read_ids(spark, path, task_ids=50)) == got
    digest = by_start(token_files.read_ids(spark, path, digest=True, task_ids=900))
    assert digest == [(d, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, s, n, ids in got]


def test_arrays_repeats_and_stray_files(spark, tmp_path):
    data = [(3, [5, 2**31 - 1], "x"), (None, [9], "y"), (1, None, "z"), (1, [], "z"), (3, [5, 2**31 - 1], "x")]
    table = spark.createDataFrame(data, "doc_id long, ids array<int>, start string")
    path = str(tmp_path / "ids")
    token_files.write_ids(table, path)
    (tmp_path / "ids" / "shard-000000-left-by-a-lost-task.tok").write_bytes(b"half a shar")
    got = sorted((r.start, r.doc_id or 0, r.ids) for r in token_files.read_ids(spark, path).collect())
    assert got == [(0, 0, [9]), (1, 1, []), (1, 1, []), (1, 3, [5, 2**31 - 1]), (3, 3, [5, 2**31 - 1])]
    with pytest.raises(Exception, match="written once"):
        token_files.write_ids(table, path)
    named = {s["name"] for s in json.loads((tmp_path / "ids" / "manifest.json").read_text())["shards"]}
    assert named <= {p.name for p in (tmp_path / "ids").iterdir()}


def test_damage_is_seen(spark, tmp_path):
    path = tmp_path / "ids"
    token_files.write_ids(spark.range(50).selectExpr("id AS doc_id", "array(int(id), 7) AS ids").coalesce(1), str(path))
    shard = next(path.glob("shard-*"))
    data = bytearray(shard.read_bytes())
    data[-60] ^= 1
    shard.write_bytes(bytes(data))
    with pytest.raises(Exception, match="not a whole token file"):
        token_files.read_ids(spark, str(path)).collect()


def test_empty_table(spark, tmp_path):
    token_files.write_documents(spark.createDataFrame([], SCHEMA), str(tmp_path / "ids"))
    assert token_files.read_ids(spark, str(tmp_path / "ids")).collect() == []
    assert token_files.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_document_is_read_in_parts(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_000, 700_000).astype(np.uint32)
    store, place = token_files.store_of(str(tmp_path))
    shard = token_files.Shard(store.open_output_stream(f"{place}/one"))
    shard.add(pa.array([7, 8]), ids, np.array([699_000, 1_000]))
    assert shard.close() == (2, 700_000)
    with store.open_input_file(f"{place}/one") as stream:
        parts = list(token_files.ShardFile(stream).documents(0, 2))
    assert len(parts) > 3 and max(len(p) for _, p, _ in parts) <= token_files.CHUNK_BLOCKS * token_files.BLOCK
    assert (np.concatenate([p for d, p, _ in parts if d == 0]) == ids[:699_000]).all()


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="driver tables are not here")
def test_query_equals_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = {r.doc_id: r for r in QUERIES["op11_token_blocks"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for r in sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
