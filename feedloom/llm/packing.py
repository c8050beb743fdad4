"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become token ids in Arrow batches, one row per piece. Packing is bounded-space online
best-fit: a task holds a fixed number of open bins, a bitset has one bit for each amount of free
space that an open bin offers, and the lowest bit at or above a piece's length is the tightest bin.
Where a new bin is due and all are open, the fullest one closes first. Memory is the open bins alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import once_per_worker
from feedloom.session import materialise

LIMIT = 2048
OPEN_BINS = 512
#: Tokens that one packing task gets; each task ends with some bins half full, so tasks are large.
TASK_TOKENS = 16_777_216
#: Words that a Python worker remembers, about 200 bytes each, and as many pre-tokens.
CACHED_WORDS = 300_000
#: Documents that are tokenised at once.
BATCH_DOCUMENTS = 2_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class TokenIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Where the tokenizer drops white space between words, a text's ids are those of its words, one
    after another, so each word is looked up in a bounded cache first. A new word of Latin letters
    with full stops or commas behind it is two pre-tokens, lower-cased, and goes to the tokenizer's
    model directly; all other words go through the whole tokenizer. Tokenizers of other kinds get
    whole texts.
    """

    SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.by_word = self._drops_blanks()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, 256)) if not c.isspace()}

    def _drops_blanks(self) -> bool:
        spec = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if normal != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            return False
        split, level = steps
        pattern = split["pattern"].get("Regex", "")
        return (
            split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]
            and "[\\p{L}]+" in pattern and "[^\\s\\p{L}\\p{N}]+" in pattern
        )

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            ids = [t.id for t in self.tokenizer.model.tokenize("".join([self.letters[c] for c in part]))]
            found = self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def _learn(self, words: list[bytes]) -> None:
        if len(self.parts) > CACHED_WORDS:
            self.parts.clear()
        rest = []
        for word in words:
            text = word.decode("utf-8")
            simple = self.SIMPLE.fullmatch(text)
            if simple is None:
                rest.append((word, text))
            else:
                core, tail = simple.groups()
                self.cache[word] = self._part(core.lower()) + (self._part(tail) if tail else b"")
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            self.cache.update(zip([w for w, _ in part], self._whole([t for _, t in part])))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; words are learned for many texts at once."""
        if not self.by_word:
            for text in texts:
                yield self._whole([text.decode("utf-8")])[0]
            return
        pending: list[list[bytes]] = []
        size = 0
        for text in texts:
            words = text.split()
            pending.append(words)
            size += len(words)
            if size >= 250_000:
                yield from self._flush(pending)
                pending, size = [], 0
        yield from self._flush(pending)

    def _flush(self, pending: list[list[bytes]]) -> Iterator[bytes]:
        wanted = set().union(*pending)
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        self._learn([w for w in wanted if w not in self.cache])
        get = self.cache.__getitem__
        for words in pending:
            yield b"".join(map(get, words))


def token_ids(path: str) -> TokenIds:
    """The encoder of a vocabulary file, kept for the later tasks of a Python worker."""
    return once_per_worker(("token ids", path), lambda: TokenIds(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``limit`` ids: ``(doc_id, piece, start, length, ids_crc32[, ids])``.

    A document is its ids and ``end_id``. Only a longer one is cut, every ``limit`` ids. A null text
    counts as empty and yields the one piece ``[end_id]``; a null ``doc_id`` stays null; repeated rows
    are documents of their own; other columns are ignored. ``tokenizer`` is a file that every
    executor can read.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(path)
        for batch in (part.slice(at, BATCH_DOCUMENTS) for part in batches for at in range(0, part.num_rows, BATCH_DOCUMENTS)):
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, found in enumerate(encoder.encode(texts)):
                found += end
                for k, at in enumerate(range(0, len(found), 4 * limit)):
                    part = found[at : at + 4 * limit]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


class OpenBins:
    """A fixed number of open bins, kept by their free space."""

    def __init__(self, limit: int, most: int, first: int = 0):
        self.limit, self.most, self.next = limit, most, first
        self.bits, self.count = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(limit + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            name = self._take(free)
        else:
            free, name = self.limit, self.next
            self.next += 1
            if length < free and self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = free - length
        if left:
            self.by_free[left].append(name)
            self.bits |= 1 << left
            self.count += 1
        return name, self.limit - free


def best_fit(pieces: DataFrame, limit: int = LIMIT, open_bins: int = OPEN_BINS, tasks: int = 1) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each of ``tasks`` tasks packs its share on its own.

    The order inside a task is that of a hash of the id, so a task that is run again packs alike.
    Columns of ``pieces`` beside ``doc_id``, ``piece`` and ``length`` pass through.
    """
    order = [F.xxhash64("doc_id", "piece"), "doc_id", "piece", "length"]
    dealt = pieces.repartition(tasks, "doc_id").sortWithinPartitions(*order)
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    place = pieces.columns.index("length")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(limit, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p[0] for p in placed], pa.int64()), pa.array([p[1] for p in placed], pa.int64())],
                schema.fieldNames(),
            )

    return dealt.mapInArrow(pack, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = LIMIT,
    open_bins: int = OPEN_BINS,
    end_id: int = 0,
    with_ids: bool = False,
    task_tokens: int = TASK_TOKENS,
) -> DataFrame:
    """Pack whole documents into sequences of at most ``limit`` tokens.

    ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``. The pieces are written
    once, because the number of packing tasks follows from their tokens. Edge cases are those of
    :func:`token_pieces`; an empty table gives an empty result.
    """
    pieces = materialise(token_pieces(docs, tokenizer, limit, end_id, with_ids), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    return best_fit(pieces, limit, open_bins, max(1, round(total / task_tokens)))
