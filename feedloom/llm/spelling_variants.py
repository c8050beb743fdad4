"""Spelling variants grouped by k-d trees over letter-count vectors.

Two words one edit apart have letter counts at most two apart in all: a replaced letter takes one count down and
another up, an inserted one takes one up. So the words near a word lie in a small box around its counts.

A first k-d tree, fitted on a bounded sample, cuts the space of counts into cells and deals every word to the one
that holds it. Its splits are over sums of counts of disjoint groups of letters, for which the same bounds hold. A
word also visits each other cell that its box reaches. Within a cell there is one exact k-d tree for each length;
visitors go through those of their own length and of one letter less and more, all at once, and a branch keeps
those whose box it can meet. What is left at the leaves is verified letter by letter.

No pair leaves its cell: a visitor takes along how many words are near and the best of them, and these add up over
cells. Words of one letter-count vector are never near each other, so not even many anagrams compare in pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Spans, batch_of, lean, lowered, row_of, text_buffer
from feedloom.session import materialise

#: Words that the cells are fitted on, about; taken by a hash of the word.
SAMPLE_WORDS = 262_144
#: Words of a cell, as long as the sample has SAMPLE_CELL of them for each.
CELL_WORDS, SAMPLE_CELL = 16_384, 16
#: Words of a leaf of a cell's own trees.
LEAF_WORDS = 48
#: Groups of letters that the cells are cut by.
GROUPS = 8
#: Letter columns of the exact vectors: 26 and the others folded, which only brings vectors closer.
COLUMNS = 32
LEAST_LETTERS, LEAST_TIMES, RATIO = 7, 2, 10
FOUND = "word string, n_near long, form string, form_n long"


def crc_table() -> np.ndarray:
    """The table of the CRC-32 of zlib, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """``crc32`` of each span of bytes, going on from the values ``begun``."""
    table = crc_table()
    order = np.argsort(starts - ends, kind="stable")
    at, size = starts[order], (ends - starts)[order]
    crc = begun[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    left = len(at)
    for k in range(min(int(size[0]) if len(size) else 0, 64)):
        left = int(np.searchsorted(-size[:left], -k, side="left"))
        step = table[(crc[:left] ^ data[at[:left] + k]) & np.uint32(255)]
        crc[:left] = step ^ (crc[:left] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > 64).tolist():
        crc[k] = zlib.crc32(data[at[k] + 64 : at[k] + size[k]].tobytes(), int(crc[k]))
    out = np.empty(len(crc), np.uint32)
    out[order] = crc
    return out


def runs_of(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, the bytes after C3."""
    lead = data == 0xC3
    low = data | 32
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = lead | ((low >= 97) & (low <= 122) & (data < 128))
    inside[2:-1] |= lead[:-1]
    steps = np.diff(inside)
    first = np.zeros(len(data) + 1, bool)
    first[limits] = True
    joints = np.flatnonzero(first[1:-1] & (inside[1:-2] == 1) & (inside[2:-1] == 1)) + 1
    starts = np.sort(np.concatenate([np.flatnonzero(steps == 1), joints]))
    ends = np.sort(np.concatenate([np.flatnonzero(steps == -1), joints]))
    return starts, ends


def counted_words(docs: DataFrame, divisor: int = 31, least: int = LEAST_LETTERS, times: int = LEAST_TIMES) -> DataFrame:
    """``(word, n)`` over all documents, after the letter that a run's checksum chooses is gone.

    Runs are counted once per document and batch before words are shuffled.
    """

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                yield _count(batch.slice(at, 2_000), divisor, least)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _count(batch: pa.RecordBatch, divisor: int, least: int) -> pa.RecordBatch:
    data, limits = text_buffer(batch.column(1))
    data = lowered(data)
    starts, ends = runs_of(data, limits)
    leads = np.concatenate([[0], np.cumsum(data == 0xC3)])
    letters = ends - starts - (leads[ends] - leads[starts])
    kept = letters >= least
    starts, ends, letters = starts[kept], ends[kept], letters[kept]
    rows = row_of(limits, starts)
    hashes = Spans(data).hashes(starts, ends)
    by = np.lexsort((rows, hashes))
    hashes, rows, starts, ends, letters = hashes[by], rows[by], starts[by], ends[by], letters[by]
    fresh = np.ones(len(by), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(by)))
    hashes, rows, starts, ends, letters = hashes[at], rows[at], starts[at], ends[at], letters[at]
    names = ["" if d is None else str(d) for d in batch.column(0).to_pylist()]
    begun = np.array([zlib.crc32(f"{name}:".encode()) for name in names], np.uint32)
    found = crcs(data, starts, ends, begun[rows] if len(rows) else np.zeros(0, np.uint32))
    hit = found % np.uint32(divisor) == 0
    whole = data.tobytes()
    counts: dict[bytes, int] = {}
    for k in np.flatnonzero(hit & (letters > least)).tolist():
        word = whole[starts[k] : ends[k]].decode("utf-8")
        gone = int(found[k]) % len(word)
        key = (word[:gone] + word[gone + 1 :]).encode()
        counts[key] = counts.get(key, 0) + int(times[k])
    hashes, times, starts, ends = hashes[~hit], times[~hit], starts[~hit], ends[~hit]
    if len(hashes):
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), np.add.reduceat(times, first).tolist()):
            key = whole[a:b]
            counts[key] = counts.get(key, 0) + n
    return batch_of(word=pa.array(list(counts), pa.binary()).cast(pa.string()), n=pa.array(list(counts.values()), pa.int64()))


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters as one array of code points below 256, and the words' limits in it."""
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


def folded(codes: np.ndarray) -> np.ndarray:
    """The letter column of each code point: a to z have one each, all others share six."""
    return np.where(codes < 128, codes.astype(np.int64) - 97, 26 + codes % (COLUMNS - 26))


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts of the words, one row each."""
    codes, limits = letters_of(words)
    row = np.repeat(np.arange(len(words)), np.diff(limits))
    return np.bincount(row * COLUMNS + folded(codes), minlength=len(words) * COLUMNS).reshape(-1, COLUMNS).astype(np.int32)


def letter_groups(counts: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The group of each letter column, dealt so that the groups hold about as many letters."""
    out, load = np.zeros(COLUMNS, np.int64), np.zeros(groups)
    for column in np.argsort(-counts.sum(axis=0), kind="stable").tolist():
        group = int(np.argmin(load))
        out[column] = group
        load[group] += counts[:, column].sum() + 1e-9
    return out


def grouped(counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    return np.stack([counts[:, groups == g].sum(axis=1) for g in range(int(groups.max()) + 1)], axis=1)


class Cells:
    """A k-d tree whose leaves are the cells; a split sends counts up to ``limit`` to the left."""

    def __init__(self, sums: np.ndarray, cells: int):
        self.axis, self.limit, self.left, self.right, self.cell = [], [], [], [], []
        self.cells = 0
        self._grow(sums, cells)

    def _node(self) -> int:
        for column, value in ((self.axis, -1), (self.limit, 0), (self.left, -1), (self.right, -1), (self.cell, -1)):
            column.append(value)
        return len(self.axis) - 1

    def _grow(self, sums: np.ndarray, cells: int) -> int:
        node = self._node()
        best = None
        for axis in range(sums.shape[1]) if cells > 1 and len(sums) > 1 else ():
            values, counts = np.unique(sums[:, axis], return_counts=True)
            if len(values) > 1:
                share = np.cumsum(counts)[:-1] / len(sums)
                k = int(np.argmin(abs(share - 0.5)))
                # an even split that few words stand next to
                cost = abs(share[k] - 0.5) + 0.5 * (counts[k] + counts[k + 1]) / len(sums)
                if best is None or cost < best[0]:
                    best = (cost, axis, int(values[k]), share[k])
        if best is None:
            self.cell[node] = self.cells
            self.cells += 1
            return node
        _, axis, limit, share = best
        below = sums[:, axis] <= limit
        few = min(max(round(cells * share), 1), cells - 1)
        self.axis[node], self.limit[node] = axis, limit
        self.left[node] = self._grow(sums[below], few)
        self.right[node] = self._grow(sums[~below], cells - few)
        return node

    def reached(self, sums: np.ndarray, up: int = 1, down: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """``(row, cell)`` of the cells that at most ``up`` counts more and ``down`` fewer can lead to."""
        rows, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        axes = sums.shape[1]
        low, high = np.full(axes, -(1 << 30)), np.full(axes, 1 << 30)

        def go(node: int, chosen: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            if not len(chosen):
                return
            axis = self.axis[node]
            if axis < 0:
                rows.append(chosen)
                cells.append(np.full(len(chosen), self.cell[node]))
                return
            for child, edge, bound in ((self.left[node], high, self.limit[node]), (self.right[node], low, self.limit[node] + 1)):
                kept = edge[axis]
                edge[axis] = bound
                mine = sums[chosen]
                rise = np.maximum(low - mine, 0).sum(axis=1)
                fall = np.maximum(mine - high, 0).sum(axis=1)
                go(child, chosen[(rise <= up) & (fall <= down)], low, high)
                edge[axis] = kept

        go(0, np.arange(len(sums)), low, high)
        return np.concatenate(rows), np.concatenate(cells)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters ``a`` and ``b`` are one edit apart; ``b`` is as long as ``a`` or one letter longer."""
    size = a.shape[1]
    same = a == b[:, :size]
    if b.shape[1] == size:
        return (~same).sum(axis=1) == 1
    first = np.where(same.all(axis=1), size, np.argmin(same, axis=1))
    shifted = a == b[:, 1:]
    last = size - np.where(shifted.all(axis=1), size, np.argmin(shifted[:, ::-1], axis=1))
    return first >= last


class LetterTree:
    """A k-d tree over the letter counts of words of one length, with their letters at the leaves."""

    def __init__(self, counts: np.ndarray, letters: np.ndarray, n: np.ndarray, places: np.ndarray, leaf: int = LEAF_WORDS):
        self.counts, self.letters, self.n, self.places, self.leaf = counts, letters, n, places, leaf

    def search(self, counts: np.ndarray, letters: np.ndarray, found: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
        """Add the near words of the visitors to ``found``, ``best`` and the place ``who`` of the best.

        Visitors and words go down together: a node halves its words at a median and keeps the visitors that
        its box can be near to.
        """
        step = letters.shape[1] - self.letters.shape[1]
        self._go(np.arange(len(self.counts)), np.arange(len(counts)), (counts, letters, step, found, best, who))

    def _go(self, words: np.ndarray, visitors: np.ndarray, asked: tuple) -> None:
        counts, _, step, *_ = asked
        mine = self.counts[words]
        low, high = mine.min(axis=0), mine.max(axis=0)
        theirs = counts[visitors]
        # a visitor's counts may lie above the box by one, and below it by one, or by as much as lengths tell
        fall = np.maximum(theirs - high, 0).sum(axis=1)
        rise = np.maximum(low - theirs, 0).sum(axis=1)
        visitors = visitors[(fall <= (step >= 0)) & (rise <= (step <= 0))]
        if not len(visitors):
            return
        if len(words) <= self.leaf or (low == high).all():
            for at in range(0, len(words), self.leaf):
                self._compare(words[at : at + self.leaf], visitors, asked)
            return
        axis = int(np.argmax(mine.var(axis=0)))
        values = np.sort(mine[:, axis])
        middle = values[len(values) // 2]
        below = mine[:, axis] < middle if middle > values[0] else mine[:, axis] <= middle
        self._go(words[below], visitors, asked)
        self._go(words[~below], visitors, asked)

    def _compare(self, words: np.ndarray, visitors: np.ndarray, asked: tuple) -> None:
        counts, letters, step, found, best, who = asked
        apart = 1 if step else 2
        for at in range(0, len(visitors), 8_192):
            part = visitors[at : at + 8_192]
            gap = np.abs(counts[part][:, None, :] - self.counts[words][None, :, :]).sum(axis=2, dtype=np.int16)
            # folded columns may bring two words closer than they are, so a gap of 0 is looked at as well
            v, w = np.nonzero(gap <= apart)
            v, w = part[v], words[w]
            a, b = letters[v], self.letters[w]
            good = near(a, b) if step <= 0 else near(b, a)
            v, w = v[good], w[good]
            np.add.at(found, v, 1)
            order = np.lexsort((-self.places[w], self.n[w], v))
            v, w = v[order], w[order]
            last = np.flatnonzero(np.append(v[1:] != v[:-1], True)) if len(v) else np.zeros(0, np.int64)
            v, w = v[last], w[last]
            better = (self.n[w] > best[v]) | ((self.n[w] == best[v]) & (self.places[w] < who[v]))
            best[v[better]], who[v[better]] = self.n[w[better]], self.places[w[better]]


def cell_neighbours(words: list[str], n: np.ndarray, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word the number of near words among the ``owned`` ones, the best one's ``n`` and its place.

    ``words`` are in code-point order, so the lowest place wins a tie. Without a near word the place is -1.
    """
    found, best, who = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    counts = np.minimum(vectors(words), 127).astype(np.int8)
    codes, limits = letters_of(words)
    sizes = np.diff(limits)
    by_size = {}
    for size in np.unique(sizes).tolist():
        members = np.flatnonzero(sizes == size)
        by_size[size] = (members, codes[limits[members][:, None] + np.arange(size)])
    for size, (members, letters) in by_size.items():
        mine = owned[members]
        if not mine.any():
            continue
        places = members[mine]
        tree = LetterTree(counts[places], letters[mine], n[places], places)
        for other in (size - 1, size, size + 1):
            if other in by_size:
                asking, theirs = by_size[other]
                f, b, w = found[asking], best[asking], who[asking]
                tree.search(counts[asking], theirs, f, b, w)
                found[asking], best[asking], who[asking] = f, b, w
    return found, best, np.where(found > 0, who, -1)


def near_words(words: DataFrame, sample: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """``(word, n_near, form, form_n)`` of every word of a written table ``(word, n)`` that has a near word."""
    total = words.count()
    # a hash below this takes about ``sample`` words, whatever the number of tasks
    cut = min(1.0, sample / max(total, 1)) * 2**32
    drawn = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < cut).select("word").toArrow()["word"].to_pylist()
    counts = vectors(drawn) if drawn else np.zeros((1, COLUMNS), np.int32)
    groups = letter_groups(counts)
    cells = Cells(grouped(counts, groups), max(1, min(-(-total // cell_words), len(drawn) // SAMPLE_CELL)))

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 50_000):
                part = batch.slice(at, 50_000)
                sums = grouped(vectors(part.column(0).to_pylist()), groups)
                row, cell = cells.reached(sums)
                _, home = cells.reached(sums, 0, 0)
                own = np.empty(len(sums), np.int64)
                own[cells.reached(sums, 0, 0)[0]] = home
                yield batch_of(cell=pa.array(cell), owned=pa.array(own[row] == cell), word=part.column(0).take(pa.array(row)), n=part.column(1).take(pa.array(row)))

    def look(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("word")
        names, n, owned = (rows[c].to_numpy(zero_copy_only=False) for c in ("word", "n", "owned"))
        found, best, who = cell_neighbours(names.tolist(), n, owned.astype(bool))
        kept = np.flatnonzero(found)
        return pa.table({
            "word": pa.array(names[kept], pa.string()), "n_near": found[kept],
            "form": pa.array(names[who[kept]], pa.string()), "form_n": best[kept],
        })

    dealt = words.select("word", "n").mapInArrow(deal, "cell long, owned boolean, word string, n long")
    found = dealt.groupBy("cell").applyInArrow(look, FOUND)
    # the largest n, then the smallest word
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of a written table ``(word, form)``: forms followed to the last, two steps for one each round.

    A form is at least ten times as frequent as its word, so no path is longer than the digits of the largest
    count, and a few rounds end it.
    """
    paths = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        moved = paths.join(ahead, paths["root"] == F.col("__at"), "left")
        paths = materialise(moved.select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        if paths.filter("moved").isEmpty():
            return paths.select("word", "root")
        paths = paths.drop("moved")


def variants(docs: DataFrame, ratio: int = RATIO, sample: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of all words of ``docs(doc_id, text)``.

    Null, empty and blank texts have no words. A null ``doc_id`` counts as the empty text in the checksum.
    Repeated rows count each. Of near words with the same ``n`` the smallest in code-point order is the form.
    Other columns are ignored; an empty table gives an empty result.
    """
    words = materialise(counted_words(docs), "words")
    found = near_words(words, sample, cell_words)
    formed = F.col("form_n") >= ratio * F.col("n")
    joined = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    joined = materialise(joined, "forms")
    last = roots(joined.filter("form IS NOT NULL").select("word", "form"))
    return joined.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
