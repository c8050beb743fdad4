"""Token ids in binary files of patched frame-of-reference blocks, as a Spark data source.

A shard file holds the ids of its documents one after another, cut into blocks of 1 024 ids. A block keeps its
minimum once and what its ids exceed it by in ``width`` bits each, where ``width`` holds a given percentage of
the block; ids above that go to an exception list of places and full differences. After the blocks comes the
index: where each block starts, where each document's ids end, and the document ids. So a range of documents is
read by the blocks that hold it. All numbers are little-endian.

    shard    "FLTOKEN1", blocks, u64 block starts, u64 document ends, i64 doc_id, u8 doc_id given, footer
    block    u32 minimum, u8 width, u8 0, u16 exceptions, width * 16 u64 packed, u16 places, u32 differences
    packed   the ids as 64 rows of 16; a column's 64 differences fill ``width`` words, low bits first
    footer   u64 blocks, u64 documents, u64 ids, u64 place of the index, u32 crc32 of the index, "FLT1"

Every task of a write makes one shard under a name of its own and reports it to the driver, which writes the
manifest once all have ended. Readers go by the manifest alone, so a task that is run again leaves nothing that
counts. The shards of the manifest are in ascending order of ``doc_id``.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from feedloom.llm.common import batch_of
from feedloom.llm.packing import default_tokenizer, token_ids
from feedloom.session import scratch_path

FORMAT = "token_blocks"
MAGIC, END = b"FLTOKEN1", b"FLT1"
ROWS, COLUMNS = 64, 16
BLOCK = ROWS * COLUMNS
#: Percentage of a block's ids that its width holds; the others are exceptions.
PERCENT = 90
#: Blocks that are coded or decoded at once.
CHUNK_BLOCKS = 256
#: Ids of a shard that one reading task takes.
TASK_IDS = 16_777_216
HEAD, FOOTER = "<IBBH", "<QQQQI4s"
HEAD_SIZE, FOOTER_SIZE = struct.calcsize(HEAD), struct.calcsize(FOOTER)
MANIFEST = "manifest.json"


def pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Differences ``(n, BLOCK)`` of ``width`` bits as ``(n, width * COLUMNS)`` 64-bit words."""
    rows = rest.reshape(-1, ROWS, COLUMNS)
    words = np.zeros((len(rows), width, COLUMNS), np.uint64)
    for row in range(ROWS if width else 0):
        word, shift = divmod(row * width, 64)
        words[:, word] |= rows[:, row] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, row] >> np.uint64(64 - shift)
    return words.reshape(len(rows), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of :func:`pack`."""
    words = words.reshape(len(words), width, COLUMNS)
    rows = np.zeros((len(words), ROWS, COLUMNS), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for row in range(ROWS if width else 0):
        word, shift = divmod(row * width, 64)
        found = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            found |= words[:, word + 1] << np.uint64(64 - shift)
        rows[:, row] = found & mask
    return rows.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray, percent: int = PERCENT) -> list[bytes]:
    """Blocks of unsigned 32-bit ``ids``; the last one is filled up with its smallest id."""
    if len(ids) == 0:
        return []
    short = -len(ids) % BLOCK
    if short:
        ids = np.concatenate([ids, np.full(short, ids[len(ids) + short - BLOCK :].min(), ids.dtype)])
    values = ids.reshape(-1, BLOCK)
    low = values.min(axis=1)
    rest = (values - low[:, None]).astype(np.uint64)
    at = max(0, -(-BLOCK * percent // 100) - 1)
    widths = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1].astype(np.uint64)
    over = rest >> widths[:, None] != 0
    row, place = np.nonzero(over)
    extra = rest[row, place].astype("<u4")
    place = place.astype("<u2")
    ends = np.searchsorted(row, np.arange(len(values)), side="right")
    rest[over] = 0
    packed: list[bytes] = [b""] * len(values)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        for k, words in zip(chosen.tolist(), pack(rest[chosen], width)):
            packed[k] = words.astype("<u8").tobytes()
    out, begin = [], 0
    for k, end in enumerate(ends.tolist()):
        head = struct.pack(HEAD, int(low[k]), int(widths[k]), 0, end - begin)
        out.append(b"".join((head, packed[k], place[begin:end].tobytes(), extra[begin:end].tobytes())))
        begin = end
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` of ``data``, padding included."""
    heads = [struct.unpack_from(HEAD, data, at) for at in starts.tolist()]
    widths = np.array([h[1] for h in heads], np.int64)
    out = np.zeros((len(heads), BLOCK), np.uint64)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        words = [np.frombuffer(data, "<u8", width * COLUMNS, int(starts[k]) + HEAD_SIZE) for k in chosen]
        out[chosen] = unpack(np.array(words, np.uint64).reshape(len(chosen), -1), width)
    for k, (low, width, _, extra) in enumerate(heads):
        if extra:
            at = int(starts[k]) + HEAD_SIZE + 8 * width * COLUMNS
            place = np.frombuffer(data, "<u2", extra, at)
            out[k, place] = np.frombuffer(data, "<u4", extra, at + 2 * extra)
        out[k] += np.uint64(low)
    return out.ravel().astype("<u4")


class Shard:
    """Writes one shard to an open binary stream; memory is a chunk of blocks and the index."""

    def __init__(self, stream, percent: int = PERCENT):
        self.stream, self.percent = stream, percent
        self.at = len(MAGIC)
        self.starts: list[int] = []
        self.ends: list[np.ndarray] = []
        self.names: list[pa.Array] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        stream.write(MAGIC)

    def add(self, names: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents with their ids one after another."""
        self.names.append(names.cast(pa.int64()))
        self.ends.append(self.n_ids + np.cumsum(lengths, dtype=np.uint64))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= CHUNK_BLOCKS * BLOCK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n
        for first in range(0, n, CHUNK_BLOCKS * BLOCK):
            for block in encode_blocks(ids[first : min(first + CHUNK_BLOCKS * BLOCK, n)], self.percent):
                self.starts.append(self.at)
                self.at += len(block)
                self.stream.write(block)

    def close(self) -> tuple[int, int]:
        """``(documents, ids)`` of the ended shard."""
        self._flush(self.n_waiting)
        names = pa.concat_arrays(self.names) if self.names else pa.array([], pa.int64())
        index = b"".join((
            np.array(self.starts, "<u8").tobytes(),
            np.concatenate([np.zeros(0, np.uint64), *self.ends]).astype("<u8").tobytes(),
            names.fill_null(0).to_numpy().astype("<i8").tobytes(),
            names.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
        ))
        self.stream.write(index)
        self.stream.write(struct.pack(FOOTER, len(self.starts), len(names), self.n_ids, self.at, zlib.crc32(index), END))
        self.stream.close()
        return len(names), self.n_ids


class ShardFile:
    """A shard open for reading: its index, and the ids of any range of its documents."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        tail = stream.read_at(FOOTER_SIZE, size - FOOTER_SIZE)
        blocks, docs, self.n_ids, self.index_at, crc, end = struct.unpack(FOOTER, tail)
        index = stream.read_at(size - FOOTER_SIZE - self.index_at, self.index_at)
        if end != END or stream.read_at(len(MAGIC), 0) != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a whole token file")
        self.starts = np.frombuffer(index, "<u8", blocks).astype(np.int64)
        self.ends = np.frombuffer(index, "<u8", docs, 8 * blocks).astype(np.int64)
        names = np.frombuffer(index, "<i8", docs, 8 * (blocks + docs))
        given = np.frombuffer(index, np.uint8, docs, 8 * (blocks + 2 * docs))
        self.names = pa.array(names.astype(np.int64), pa.int64(), mask=given == 0)

    def ids(self, begin: int, end: int) -> Iterator[np.ndarray]:
        """The ids of the places ``begin`` to ``end``, a chunk of blocks at a time."""
        for first in range(begin // BLOCK, -(-end // BLOCK), CHUNK_BLOCKS):
            last = min(first + CHUNK_BLOCKS, -(-end // BLOCK))
            at = int(self.starts[first])
            until = int(self.starts[last]) if last < len(self.starts) else self.index_at
            found = decode_blocks(self.stream.read_at(until - at, at), self.starts[first:last] - at)
            yield found[max(begin - first * BLOCK, 0) : end - first * BLOCK]

    def documents(self, first: int, last: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """``(document, part of its ids, whether they end with it)`` in file order; long documents come in parts."""
        begin = int(self.ends[first - 1]) if first else 0
        doc, at = first, begin
        for part in self.ids(begin, int(self.ends[last - 1])):
            used = 0
            while doc < last and (used < len(part) or self.ends[doc] == at):
                take = min(int(self.ends[doc]) - at, len(part) - used)
                at += take
                done = at == self.ends[doc]
                yield doc, part[used : used + take], done
                used += take
                doc += done
        for empty in range(doc, last):
            yield empty, np.zeros(0, "<u4"), True


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the place in it of a URI or a plain path."""
    return fs.FileSystem.from_uri(path)


def read_manifest(path: str) -> list[dict]:
    store, place = store_of(path)
    with store.open_input_file(f"{place}/{MANIFEST}") as file:
        return json.loads(file.read())["shards"]


@dataclass
class WrittenShard(WriterCommitMessage):
    name: str
    order: int
    documents: int
    ids: int


@dataclass
class Documents(InputPartition):
    """Documents ``first`` to ``last`` of a shard, whose first id has ``base`` ids before it."""

    name: str
    first: int
    last: int
    base: int


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, path: str, percent: int, overwrite: bool):
        self.path, self.percent, self.overwrite = path, percent, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenShard:
        store, place = store_of(self.path)
        order = TaskContext.get().partitionId()
        name = f"shard-{order:06d}-{uuid.uuid4().hex}.tok"
        store.create_dir(place, recursive=True)
        try:
            shard = Shard(store.open_output_stream(f"{place}/{name}"), self.percent)
            for batch in (whole.slice(at, 1_000) for whole in iterator for at in range(0, whole.num_rows, 1_000)):
                names, column = batch.column("doc_id"), batch.column("ids")
                if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
                    parts = [x.as_buffer() if x.is_valid else b"" for x in column]
                    lengths = np.array([len(p) // 4 for p in parts], np.int64)
                    ids = np.frombuffer(b"".join(parts), "<u4")
                else:
                    lengths = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
                    ids = column.flatten().to_numpy().astype(np.int64).astype(np.uint32)
                shard.add(names, ids, lengths)
            return WrittenShard(name, order, *shard.close())
        except Exception:
            self._remove([name])
            raise

    def _remove(self, names: list[str]) -> None:
        store, place = store_of(self.path)
        for name in names:
            if store.get_file_info(f"{place}/{name}").type == fs.FileType.File:
                store.delete_file(f"{place}/{name}")

    def commit(self, messages: list[WrittenShard | None]) -> None:
        store, place = store_of(self.path)
        store.create_dir(place, recursive=True)
        there = store.get_file_info(f"{place}/{MANIFEST}").type == fs.FileType.File
        if there and not self.overwrite:
            raise ValueError("a token folder is written once; overwrite it or take another")
        old = [s["name"] for s in read_manifest(self.path)] if there else []
        shards = sorted((m for m in messages if m is not None), key=lambda m: m.order)
        text = json.dumps({"shards": [{"name": m.name, "documents": m.documents, "ids": m.ids} for m in shards if m.documents]})
        with store.open_output_stream(f"{place}/{MANIFEST}") as file:
            file.write(text.encode())
        self._remove(old + [m.name for m in shards if not m.documents])

    def abort(self, messages: list[WrittenShard | None]) -> None:
        self._remove([m.name for m in messages if m is not None])


class TokenReader(DataSourceReader):
    def __init__(self, path: str, digest: bool, task_ids: int):
        self.path, self.digest, self.task_ids = path, digest, task_ids

    def partitions(self) -> list[Documents]:
        out, base = [], 0
        for shard in read_manifest(self.path):
            tasks = min(max(1, -(-shard["ids"] // self.task_ids)), shard["documents"])
            limits = [shard["documents"] * k // tasks for k in range(tasks + 1)]
            out += [Documents(shard["name"], a, b, base) for a, b in zip(limits, limits[1:])]
            base += shard["ids"]
        return out or [Documents("", 0, 0, 0)]

    def read(self, partition: Documents) -> Iterator[pa.RecordBatch]:
        if partition.first == partition.last:
            return
        store, place = store_of(self.path)
        with store.open_input_file(f"{place}/{partition.name}") as stream:
            shard = ShardFile(stream)
            found, size, crc, parts, begun = [], 0, 0, [], partition.first
            for doc, part, done in shard.documents(partition.first, partition.last):
                if self.digest:
                    crc = zlib.crc32(part.tobytes(), crc)
                else:
                    parts.append(part)
                    size += len(part)
                if done:
                    found.append(crc if self.digest else np.concatenate(parts) if len(parts) > 1 else parts[0])
                    crc, parts = 0, []
                    if len(found) == 10_000 or size >= 4_000_000:
                        yield self._batch(shard, partition.base, begun, found)
                        found, size, begun = [], 0, doc + 1
            if found:
                yield self._batch(shard, partition.base, begun, found)

    def _batch(self, shard: ShardFile, base: int, first: int, found: list) -> pa.RecordBatch:
        ends = shard.ends[first : first + len(found)]
        starts = np.concatenate([shard.ends[first - 1 : first] if first else np.zeros(1, np.int64), ends[:-1]])
        columns = {"doc_id": shard.names[first : first + len(found)], "start": base + starts, "n_tokens": ends - starts}
        if self.digest:
            columns["ids_crc32"] = pa.array(found, pa.int64())
        else:
            values = pa.array(np.concatenate(found).astype(np.int32))
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(ends - starts)]), pa.int32()), values)
        return batch_of(**columns)


class TokenBlocks(DataSource):
    """Writes ``(doc_id, ids)``, reads ``(doc_id, start, n_tokens, ids)`` or, with ``digest``, a crc32 for the ids.

    ``ids`` are written from an array of integers or from binary, four little-endian bytes each. Options:
    ``path``, ``percent`` (writing), ``digest`` and ``taskIds`` (reading).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _digest(self) -> bool:
        return self.options.get("digest", "false").lower() == "true"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if self._digest() else "ids array<int>")

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"], self._digest(), int(self.options.get("taskIds", TASK_IDS)))

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"], int(self.options.get("percent", PERCENT)), overwrite)


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` dealt to ranges of ``doc_id`` and sorted in each, nulls first; repeated ids by what they hold.

    A running number parts equal rows, so that even one id on a third of all rows fills no single range.
    """
    order = ["doc_id", F.xxhash64(*columns), F.monotonically_increasing_id()]
    keyed = rows.select("doc_id", *columns, *[k.alias(f"__{i}") for i, k in enumerate(order[1:])])
    keys = ["doc_id", "__0", "__1"]
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", *columns)


def _write(rows: DataFrame, path: str, percent: int) -> None:
    spark = rows.sparkSession
    spark.dataSource.register(TokenBlocks)
    rows.write.format(FORMAT).option("percent", percent).mode("append").save(path)


def write_ids(rows: DataFrame, path: str, percent: int = PERCENT) -> None:
    """Write ``rows(doc_id, ids)`` in ascending order of ``doc_id`` to a new folder; other columns are ignored.

    Null ids count as none, null document ids come first and stay null, repeated rows are documents of their
    own, an empty table gives a folder without shards.
    """
    _write(in_order(rows.select(F.col("doc_id").cast("long"), "ids"), "ids"), path, percent)


def read_ids(spark: SparkSession, path: str, digest: bool = False, task_ids: int = TASK_IDS) -> DataFrame:
    """The documents of a folder: ``(doc_id, start, n_tokens, ids)``, or ``ids_crc32`` in place of the ids.

    ``start`` is the number of ids of all documents before. A digest is made block by block, so no document has
    to fit in memory.
    """
    spark.dataSource.register(TokenBlocks)
    return spark.read.format(FORMAT).option("digest", str(digest).lower()).option("taskIds", task_ids).load(path)


def write_documents(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, percent: int = PERCENT) -> None:
    """Tokenise every whole text, end it with ``end_id`` and write the ids in ascending order of ``doc_id``.

    Texts are put in order before they are tokenised, so each is tokenised once. A null text counts as empty
    and has the end id alone; the rest is as in :func:`write_ids`.
    """
    vocabulary = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(1)]
                yield batch_of(doc_id=part.column(0), ids=pa.array([ids + end for ids in encoder.encode(texts)], pa.binary()))

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    _write(in_order(texts, "text").mapInArrow(encode, "doc_id long, ids binary"), path, percent)


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, path: str | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the files written for them."""
    folder = path or scratch_path(docs.sparkSession, "token-ids")
    write_documents(docs, folder, tokenizer, end_id)
    return read_ids(docs.sparkSession, folder, digest=True)
