"""Language identification of mixed-language text.

Every word gets a score per language from hashed byte 3- and 4-grams with its ends marked. The scripts
of its letters narrow the candidates first: a language stays in play only if its training words use
that script. Every script of Unicode is a class; letters that belong to none narrow nothing. Viterbi over
the words, with a penalty for every switch, labels spans; the language with the most letters is the
document's. The model is a table of fixed size for each labelled language, fitted on a bounded sample of its
documents; prediction is one pass without a shuffle, in Arrow batches.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import batch_of, lean, lowered, row_of, text_buffer, word_limits
from feedloom.session import materialise

#: Labelled documents per language that the model is fitted on, at most about this many.
SAMPLE_DOCS = 2_000
#: Languages whose counts the driver turns into scores at a time.
LANGUAGES_AT_ONCE = 64
#: Log-odds that a switch of language between two words costs.
SWITCH = 8.0
SLOTS = 1 << 16
#: Share of a language's training words that makes a script one of its own.
SCRIPT_SHARE = 0.01
CHUNK_BYTES = 1_000_000
#: Scores of bytes, for all languages, that are summed at a time.
PART_CELLS = 1 << 25
#: First and last code point of scripts that are known by their blocks.
SCRIPTS = (
    ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)),
    ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    ((0x400, 0x52F),),
    ((0x530, 0x58F),),
    ((0x590, 0x5FF),),
    ((0x600, 0x6FF), (0x750, 0x77F)),
    ((0x900, 0x97F),),
    ((0xE00, 0xE7F),),
    ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    ((0x3040, 0x30FF),),
    ((0x3400, 0x9FFF),),
)
#: First words of the names of their letters outside these blocks.
SCRIPT_NAMES = (
    ("LATIN",), ("GREEK",), ("CYRILLIC",), ("ARMENIAN",), ("HEBREW",), ("ARABIC",), ("DEVANAGARI",), ("THAI",),
    ("HANGUL",), ("HIRAGANA", "KATAKANA"), ("CJK",),
)
#: Letters of no one script: ordinal and modifier letters, letterlike signs, full and half width, mathematical.
COMMON = ((0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0x2B0, 0x2FF), (0x2071, 0x209C), (0x2100, 0x214F), (0xFF00, 0xFFEF), (0x1D400, 0x1D7FF))
#: The script of common letters, which narrows nothing; the lowest, so any other in a word goes before it.
OTHER = 1


def _script_table() -> tuple[np.ndarray, int]:
    """Script of every code point, 0 for what is no letter, and how many numbers there are.

    Letters outside the blocks have the first word of their Unicode name as script.
    """
    table = np.zeros(sys.maxunicode + 1, np.uint16)
    for ranges in (*SCRIPTS, COMMON):
        for low, high in ranges:
            table[low : high + 1] = OTHER
    names: dict[str, list[int]] = {}
    for point in np.flatnonzero(table[:0xE0000] == 0).tolist():
        if unicodedata.category(chr(point))[0] == "L":
            names.setdefault(unicodedata.name(chr(point), "").split(" ")[0].split("-")[0], []).append(point)
    listed = {name for group in SCRIPT_NAMES for name in group}
    number = OTHER
    for name in sorted(names.keys() - listed):
        number += 1
        table[names[name]] = number
    for ranges, group in zip(SCRIPTS, SCRIPT_NAMES):
        number += 1
        for low, high in ranges:
            table[low : high + 1] = number
        for name in group:
            table[names.get(name, [])] = number
    for low, high in COMMON:
        for point in range(low, high + 1):
            table[point] = OTHER if unicodedata.category(chr(point))[0] == "L" else 0
    return table, number + 1


SCRIPT_OF, SCRIPT_COUNT = _script_table()
SIZE = 2 * SLOTS + SCRIPT_COUNT


@dataclass
class Words:
    """The words of a run of rows: row, limits, letters, script and the n-gram slots of their bytes."""

    row: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    slots: tuple[np.ndarray, np.ndarray]
    first: np.ndarray


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of more than one UTF-8 byte that begin at the given places."""
    one = data[at].astype(np.int64)
    two, three, four = ((data[np.minimum(at + k, len(data) - 1)] & 0x3F).astype(np.int64) for k in (1, 2, 3))
    long = np.where(one < 0xF0, (one & 0xF) << 12 | two << 6 | three, (one & 7) << 18 | two << 12 | three << 6 | four)
    return np.minimum(np.where(one < 0xE0, (one & 0x1F) << 6 | two, long), sys.maxunicode)


def words_in(data: np.ndarray, limits: np.ndarray) -> Words:
    low = lowered(data)
    starts, ends = word_limits(low, limits)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none, (none, none), none)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(starts - first, sizes)
    padded = np.concatenate([low, np.full(3, 32, np.uint8)])
    here = low[at].astype(np.uint32)
    before, after, second = padded[at - 1].astype(np.uint32), padded[at + 1].astype(np.uint32), padded[at + 2].astype(np.uint32)
    last = first + sizes - 1
    before[first] = 32
    after[last] = 32
    second[last] = 32
    second[np.maximum(last - 1, first)] = 32
    three = before << np.uint32(16) | here << np.uint32(8) | after
    four = three * np.uint32(0x9E3779B1) ^ second * np.uint32(0x85EBCA6B)
    script = np.where(here < 128, SCRIPT_OF[here], 0)
    lead = np.flatnonzero(here >= 0xC0)
    script[lead] = SCRIPT_OF[code_points(padded, at[lead])]
    return Words(
        row_of(limits, starts), starts, ends,
        np.add.reduceat((script > 0).astype(np.int64), first),
        np.maximum.reduceat(script, first).astype(np.int64),
        ((three * np.uint32(0x85EBCA6B)) >> np.uint32(16), (four * np.uint32(0xC2B2AE35)) >> np.uint32(16)),
        first,
    )


@dataclass
class Model:
    languages: list[str]
    shares: np.ndarray
    table: np.ndarray
    candidates: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Log-likelihood of every word per language.

        Words without letters, of a script that no language uses, or of common letters that tell nothing
        count 0.
        """
        found = np.zeros((len(words.row), len(self.languages)), np.float32)
        if not len(words.row):
            return found
        size, step = len(words.slots[0]), max(PART_CELLS // len(self.languages), 1)
        for begin in range(0, size, step):
            part = slice(begin, begin + step)
            cells = self.table[words.slots[0][part]] + self.table[words.slots[1][part].astype(np.int64) + SLOTS]
            low, high = np.searchsorted(words.first, begin, "right") - 1, np.searchsorted(words.first, begin + step)
            found[low:high] += np.add.reduceat(cells, np.maximum(words.first[low:high], begin) - begin, axis=0)
        found *= np.float32(0.5)
        fits = self.candidates[words.script]
        known = fits.any(axis=1) & (words.letters > 0)
        known &= (words.script != OTHER) | (found.max(axis=1) > found.min(axis=1))
        found = np.where(fits, found, found.min(axis=1, keepdims=True) - np.float32(30))
        return np.where(known[:, None], found, np.float32(0))


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word, where a switch costs ``penalty``; all rows advance together."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    steps = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(steps), side="left")
    best = np.zeros(len(scores), np.int32)
    stays = np.zeros(scores.shape, bool)
    value = scores[first[: active[0]]].copy() if steps else scores[:0]
    for t in range(1, steps):
        a = active[t]
        at = first[:a] + t
        now = value[:a]
        top = now.argmax(axis=1)
        moved = now.max(axis=1)[:, None] - np.float32(penalty)
        best[at] = top
        stays[at] = now >= moved
        # only differences matter; the highest value is taken off so that long texts keep precision
        value[:a] = np.maximum(now, moved) - moved + scores[at]
    labels = np.zeros(len(scores), np.int32)
    current = value.argmax(axis=1) if steps else np.zeros(0, np.int64)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        labels[at] = current[:a]
        if t:
            current[:a] = np.where(stays[at, current[:a]], current[:a], best[at])
    return labels


def _chunks(batch: pa.RecordBatch, column: int, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, limits = text_buffer(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(limits, limits[begin] + size, side="right")) - 1)
        yield begin, end, data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin]
        begin = end


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from ``(doc_id, text, lang)``, or None where no row has a language.

    Every language is learned. Each gives the share of its documents with the lowest hashes that yields
    about ``sample_docs``, all of them if there are fewer. The model has half a megabyte a language.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    found = rows.groupBy("lang").count().collect()
    if not found:
        return None
    languages = sorted(r["lang"] for r in found)
    number = {name: k for k, name in enumerate(languages)}
    draw = F.xxhash64("doc_id", F.lit(2)).bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(float(1 << 32))
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    sample = rows.filter(draw <= share[F.col("lang")]).select("lang", "text").repartition(8, "text")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for begin, end, data, limits in _chunks(batch, 1):
                words = words_in(data, limits)
                lang = of[begin:end][words.row] * SIZE
                cells = [np.repeat(lang, words.ends - words.starts) + slot + offset for offset, slot in zip((0, SLOTS), words.slots)]
                cell, n = np.unique(np.concatenate([*cells, lang + 2 * SLOTS + words.script]), return_counts=True)
                yield batch_of(lang=pa.array(cell // SIZE, pa.int32()), slot=pa.array(cell % SIZE, pa.int32()), n=n)

    counts = sample.mapInArrow(count, "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "grams")
    table = np.empty((2 * SLOTS, len(languages)), np.float32)
    candidates = np.zeros((SCRIPT_COUNT, len(languages)), bool)
    for begin in range(0, len(languages), LANGUAGES_AT_ONCE):
        end = min(begin + LANGUAGES_AT_ONCE, len(languages))
        part = counts.filter(F.col("lang").between(begin, end - 1)).toArrow()
        total = np.zeros((end - begin, SIZE))
        total[part.column("lang").to_numpy() - begin, part.column("slot").to_numpy()] = part.column("n").to_numpy()
        grams = total[:, : 2 * SLOTS].reshape(end - begin, 2, SLOTS)
        shares = grams / np.maximum(grams.sum(axis=2, keepdims=True), 1)
        table[:, begin:end] = np.log(shares + 1e-6).reshape(end - begin, 2 * SLOTS).T
        scripts = total[:, 2 * SLOTS :]
        candidates[:, begin:end] = (scripts >= SCRIPT_SHARE * np.maximum(scripts[:, 1:].sum(axis=1, keepdims=True), 1)).T
    candidates[0] = False
    candidates[OTHER] = True
    size = {r["lang"]: r["count"] for r in found}
    prior = np.array([size[x] for x in languages], np.float64)
    return Model(languages, prior / prior.sum(), table, candidates)


def identified(docs: DataFrame, model: Model | None, penalty: float = SWITCH, spans: bool = False) -> DataFrame:
    """``docs`` rows as ``(doc_id, lang_pred, score[, spans])``.

    ``score`` is the share of the letters in spans of the predicted language. ``und`` with score 0 is
    the answer for a null text, one without any letter, and where no language was learned. A text
    whose letters are of scripts that no language uses gets the most frequent language, with its
    share of the training documents as score. ``spans`` are ``(start, end, lang)`` in UTF-8 bytes, from
    the first word of a run to its last. Repeated rows are judged each, null ids stay null, other
    columns are ignored.
    """
    schema = "doc_id long, lang_pred string, score double" + (", spans array<struct<start:long,end:long,lang:string>>" if spans else "")
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if model is None:
        out = rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumn("spans", F.array().cast("array<struct<start:long,end:long,lang:string>>")) if spans else out
    names = np.array([*model.languages, "und"], object)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, width = batch.num_rows, len(model.languages)
            row, starts, ends, labels, known = ([np.zeros(0, np.int64)] for _ in range(5))
            for begin, end, data, limits in _chunks(batch, 1, CHUNK_BYTES * LANGUAGES_AT_ONCE // max(width, LANGUAGES_AT_ONCE)):
                words = words_in(data, limits)
                scores = model.scores(words)
                count = np.bincount(words.row, minlength=end - begin)
                labels.append(viterbi(scores, np.cumsum(count) - count, count, penalty).astype(np.int64))
                known.append(words.letters * scores.any(axis=1))
                row.append(words.row + begin)
                starts.append(words.starts - limits[words.row])
                ends.append(words.ends - limits[words.row])
            row, starts, ends, labels, known = (np.concatenate(x) for x in (row, starts, ends, labels, known))
            shares = np.bincount(row * width + labels, known, n * width).reshape(n, width)
            total = shares.sum(axis=1)
            has = np.array(batch.column(2).to_pylist(), bool)
            chosen = np.where(total > 0, shares.argmax(axis=1), model.shares.argmax())
            score = np.where(total > 0, shares.max(axis=1) / np.maximum(total, 1), model.shares.max())
            columns = {
                "doc_id": batch.column(0),
                "lang_pred": pa.array(names[np.where(has, chosen, width)], pa.string()),
                "score": np.where(has, score, 0.0),
            }
            if spans:
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (labels[1:] != labels[:-1])
                begins = np.flatnonzero(new)
                finish = np.append(begins[1:], len(row))[: len(begins)] - 1
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array(starts[begins], pa.int64()),
                        pa.array(ends[finish], pa.int64()),
                        pa.array(names[labels[begins]], pa.string()),
                    ],
                    ["start", "end", "lang"],
                )
                sizes = np.bincount(row[begins], minlength=n)
                columns["spans"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)
            yield batch_of(**columns)

    return rows.mapInArrow(work, schema)


def identify(docs: DataFrame, training: Column | None = None, spans: bool = False, **bounds) -> DataFrame:
    """Learn from the rows of ``docs`` for which ``training`` holds (all, if not given), predict every row."""
    labelled = docs.select("doc_id", "text", "lang") if training is None else docs.filter(training).select("doc_id", "text", "lang")
    return identified(docs, fit(labelled, **bounds), spans=spans)
