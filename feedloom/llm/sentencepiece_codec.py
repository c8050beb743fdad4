"""Encoding and decoding with a SentencePiece model by a streaming Viterbi search.

The search keeps one backpointer for every boundary between characters. All paths that may still win run
through a window no wider than the longest piece; as soon as their backpointers meet in one boundary, the
ids up to it are final and leave the window. So memory does not grow with the text. A boundary that no
piece of the vocabulary crosses is such a meeting point whatever the scores, and as words are separated by
these, a word's ids are looked up in a bounded cache before they are searched.

For a unigram vocabulary the winning path has the highest sum of scores. For a merge vocabulary every
prefix of a text has one encoding, and the pieces on either side of a boundary decide whether it can be
one: the edge stays only if encoding both pieces together gives these two again. Both kinds yield the ids
that the vocabulary's own library gives.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import batch_of, once_per_worker

SPACE = "▁"
#: Words and pairs of pieces that a Python worker remembers.
CACHED = 500_000
#: What an unknown character costs below the lowest score of a unigram vocabulary.
UNKNOWN = 10.0
NORMAL, BYTE, USER = 1, 6, 4


class Pieces:
    """A SentencePiece vocabulary with its search. ``path`` is a model file that every executor can read."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and merge vocabularies without a character map are supported")
        self.merges = model.trainer_spec.model_type == 2
        self.prefix, self.squeeze = normal.add_dummy_prefix, normal.remove_extra_whitespaces
        self.kinds = [p.type for p in model.pieces]
        self.names = [p.piece for p in model.pieces]
        self.scores = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.ids_of = {piece: [i] for piece, (_, i) in self.scores.items()}
        self.spelled = [self._spelling(k, name) for k, name in zip(self.kinds, self.names)]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        self.longest = max(map(len, self.scores), default=1)
        self.lowest = min((s for s, _ in self.scores.values()), default=0.0) - UNKNOWN
        # no piece goes on with the mark of a blank behind another character
        self.splits = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)
        self.inside: set[str] = set()
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            self.automaton.add_word(piece, piece)
            self.inside.update(piece[i : i + 2] for i in range(len(piece) - 1))
        self.automaton.make_automaton()
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    @staticmethod
    def _spelling(kind: int, name: str) -> bytes:
        """What a piece stands for: a byte, text, the mark of an unknown character, or nothing."""
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        if kind in (NORMAL, USER):
            return name.replace(SPACE, " ").encode("utf-8")
        return " ⁇ ".encode() if kind == 2 else b""

    def _normal(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best neighbours first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.scores.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[0] > best):
                    best, at = found[0], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _adjoin(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHED:
                self.pairs.clear()
            whole = [right] if not left else [left, right]
            known = self.pairs[left, right] = (not left or self._adjoin("", right)) and self._merged(left + right) == whole
        return known

    def _ending(self, text: str) -> Iterator[list[str]]:
        """For each boundary of ``text`` but the first the pieces that end there, longest first.

        A character that is no piece is one here. All pieces are found in one pass over the text.
        """
        found = self.automaton.iter(text)
        waiting = next(found, None)
        for end in range(1, len(text) + 1):
            pieces = []
            while waiting is not None and waiting[0] == end - 1:
                pieces.append(waiting[1])
                waiting = next(found, None)
            if not pieces or len(pieces[-1]) > 1:
                pieces.append(text[end - 1])
            yield pieces

    def _edge(self, pieces: list[str], end: int, first: int, last: dict[int, str], value: dict[int, float]) -> tuple[float, str]:
        """The winning piece that ends at ``end``: its path's value and the piece."""
        best, chosen = -np.inf, ""
        get, known = self.scores.get, self.pairs.get
        for piece in pieces:
            begin = end - len(piece)
            if begin < first:
                continue
            if self.merges:
                before = last[begin]
                fits = known((before, piece))
                if fits is None:
                    fits = self._adjoin(before, piece)
                if fits:
                    return 0.0, piece
            else:
                found = get(piece)
                total = value[begin] + (self.lowest if found is None else found[0])
                if total > best:
                    best, chosen = total, piece
        return best, chosen

    def _within_window(self, text: str) -> list[str]:
        """The pieces of a text no longer than the window, where nothing can be committed before the end.

        For merge vocabularies, as there the last piece of each boundary is all there is to keep.
        """
        last, known = [""], self.pairs.get
        ending: list[list[str]] = [[] for _ in text]
        for end, piece in self.automaton.iter(text):
            ending[end].append(piece)
        for end, pieces in enumerate(ending, 1):
            for piece in pieces:
                pair = last[-len(piece)], piece
                fits = known(pair)
                if fits is None:
                    fits = self._adjoin(*pair)
                if fits:
                    last.append(piece)
                    break
            else:  # a character that is no piece
                last.append(text[end - 1])
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def search(self, text: str) -> Iterator[str]:
        """The pieces of a normalised text, each as soon as no later character can change it."""
        if self.merges and len(text) <= self.longest:
            yield from self._within_window(text)
            return
        first = 0
        last = {0: ""}
        value = {0: 0.0}
        origin = {0: 0}
        for end, pieces in enumerate(self._ending(text), 1):
            value[end], last[end] = self._edge(pieces, end, max(first, end - self.longest), last, value)
            origin[end] = end - len(last[end])
            # boundaries that a piece may still begin at, traced back to where their paths meet
            if end < len(text) and end - first < self.longest:
                continue
            meet = set(range(end - self.longest + 1, end + 1)) if end < len(text) else {end}
            while len(meet) > 1:
                top = max(meet)
                meet = (meet - {top}) | {max(origin[top], first)}
            meeting = meet.pop()
            if meeting > first:
                path, at = [], meeting
                while at > first:
                    path.append(last[at])
                    at = origin[at]
                yield from reversed(path)
                for b in range(first, meeting):
                    last.pop(b), value.pop(b), origin.pop(b)
                first = meeting

    def _ids(self, text: str) -> list[int]:
        out: list[int] = []
        short = self.merges and len(text) <= self.longest
        for piece in self._within_window(text) if short else self.search(text):
            ids = self.ids_of.get(piece)
            if ids is None and self.bytes:  # a character that is no piece is spelled in bytes
                ids = self.ids_of[piece] = [self.bytes[b] for b in piece.encode("utf-8")]
            if ids is not None:
                out += ids
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        text = self._normal(text)
        if not self.splits or not self.bytes:
            return self._ids(text)
        out: list[int] = []
        for word in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text):
            ids = self.words.get(word)
            out += self._learned(word) if ids is None else ids
        return out

    def _learned(self, word: str) -> list[int]:
        """The ids of a word, part by part where no piece crosses from one into the next."""
        inside, begin, out = self.inside, 0, []
        for end in range(1, len(word) + 1):
            if end == len(word) or word[end - 1 : end + 1] not in inside:
                part = word if end - begin == len(word) else word[begin:end]
                ids = self.words.get(part)
                if ids is None:
                    ids = self._ids(part)
                    if len(part) <= 64:
                        self.words[part] = ids
                out += ids
                begin = end
        if len(self.words) > CACHED:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = out
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become the replacement character."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def pieces_of(path: str) -> Pieces:
    """The vocabulary of a model file, kept for the later tasks of a Python worker."""
    return once_per_worker(("pieces", path), lambda: Pieces(path))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, ids)``: the ids of every row's text.

    A null text has null ids and an empty one none. Repeated rows are encoded each, null ids of documents
    stay null, other columns are ignored, an empty table gives an empty result.
    """
    path = model or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            limits, flat, valid = [0], [], []
            for text in batch.column(1).to_pylist():
                ids = [] if text is None else pieces.encode(text)
                flat.append(np.array(ids, np.int32))
                limits.append(limits[-1] + len(ids))
                valid.append(text is not None)
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), values, mask=pa.array([not v for v in valid], pa.bool_()))
            yield batch_of(doc_id=batch.column(0), ids=lists)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(work, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of rows ``(doc_id, ids)``; null ids give a null text. Ids must be of the vocabulary."""
    path = model or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield batch_of(doc_id=batch.column(0), text=pa.array(texts, pa.string()))

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, n_pieces, ids_crc32, n_bytes, exact)``: every text encoded, and whether decoding gives it back.

    A null or empty text has no pieces and comes back as the empty one; texts of any length are searched whole;
    repeated rows have a row each, a null ``doc_id`` stays null, other columns are ignored, an empty table gives
    an empty result.
    """
    path = model or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        pieces = pieces_of(path)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                ids = pieces.encode(text or "")
                crc = zlib.crc32(np.frombuffer(array("i", ids), np.int32).astype("<u4").tobytes())
                out.append((len(ids), crc, len((text or "").encode("utf-8")), pieces.decode(ids) == (text or "")))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield batch_of(
                doc_id=batch.column(0), n_pieces=pa.array(columns[0], pa.int64()), ids_crc32=pa.array(columns[1], pa.int64()),
                n_bytes=pa.array(columns[2], pa.int64()), exact=pa.array(columns[3], pa.bool_()),
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, n_pieces long, ids_crc32 long, n_bytes long, exact boolean"
    )
