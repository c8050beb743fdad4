"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is the sequence of its words, A-Z in lower case, and its end. A word's bytes and the blank behind it
are coded as paths in a fixed binary tree, in which frequent bytes have short paths, and every branch is a
bit to predict. Three hashed contexts (three bytes, five bytes, the word so far) each hold counts of what
followed in all training texts; each gives the log-odds of the bit. Weights gated by the branch's depth and
by how well the contexts are known mix them. They start from those of greatest likelihood for all bits of all
training texts, a bit's own count taken off: the bits are tallied by depth, gate and the levels of the three
log-odds, and the tallies, whose number is bounded, are summed over all tasks before the weights are solved
for. Every text then refines its own copy: after each block of its bytes, the first of ``FIRST_BYTES``, a damped
Newton step moves the weights of each gate, for the blocks that follow. A last mixing step weighs the word's
bytes against the word as a whole, by its count, with a share for its length, which is fitted on all training words by such tallies
and refined after every block of words likewise. The bits of all words and of the end are the text's cost.

Beside it stands a word unigram. Words are counted over all training texts, none is left out; the
``TOP_WORDS`` most frequent counts go with the scoring tasks, all other words of a text are joined with the
counts, for the unigram and for the last mixing step, and as they are rare no key of that join is hot.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BASE, Spans, batch_of, lowered, text_buffer, word_limits
from feedloom.session import materialise

#: Slots of the contexts; each slot has counts of the 256 bytes that may follow.
SLOTS = (1 << 14, 1 << 16, 1 << 16)
#: Most frequent words whose counts are sent to all tasks.
TOP_WORDS = 1 << 18
#: Words after which a text's shares are refined, and the size of that step.
BLOCK = 256
STEP = 1.0
PRIOR = 0.4
#: Bytes after which a text's gated weights are refined first; each later block is twice as long, up to LAST_BYTES.
FIRST_BYTES = 64
LAST_BYTES = 4_096
#: How firmly a text holds the fitted weights, as the curvature they bring along, and the share of a Newton step.
FIRMNESS = 10.0
DAMPING = 0.25
#: Input splits whose counts one task gathers, where there are that many more than cores.
SPLITS = 8
SCALE = 12.0
GATES = 9
#: Weight of each context before any are fitted.
START = 0.4
#: Levels that a context's log-odds have while the weights are fitted, and their width in parts of 1 / SCALE.
LEVELS = 22
WIDTH = 12
#: Bins of the log-odds of words while the shares are fitted: as many for each nat, from -LEAST_ODDS on.
BINS = 1024
BINS_NAT = 8
LEAST_ODDS = 20.0
#: Word lengths with a share of their own in the last mixing step.
LENGTHS = 16
BLANK = 32
END_WORD = np.int64(-6148914691236517206)
CHUNK_BYTES = 2_000_000
#: Bytes that are worked on at a time, few enough to stay near the core.
PART_BYTES = 20_000
OFFSETS = tuple(int(x) for x in np.cumsum([0, *SLOTS]))


@dataclass
class Words:
    """The words of some rows, each different one with its size, its bytes and the blank behind it, and before each
    of these the slot of the word so far; ``starts`` has where those of each different word begin."""

    row: np.ndarray
    keys: np.ndarray
    of: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    coded: np.ndarray
    prefix: np.ndarray

    def stream(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """The bytes of all words in order, a blank behind each; where each word begins; the contexts' slots; and
        where each row with a word begins."""
        sizes = self.sizes[self.of] + 1
        ends = np.cumsum(sizes)
        first = ends - sizes
        place = np.repeat(self.starts[self.of] - first, sizes)
        place += np.arange(len(place))
        begins = first[np.append(True, self.row[1:] != self.row[:-1])[: len(first)]]
        out = self.coded.take(place)
        return out, first, contexts(out, begins, self.prefix.take(place)), begins


def side_by_side(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of all keys, equal ones side by side; the number of each one's group, in that order; and where the
    groups begin in it. Keys are sorted by the upper bits of ``value``, which is used up; where these are equal for different
    keys, a key may be in several groups."""
    low = (np.uint64(1) << np.uint64(len(key).bit_length())) - np.uint64(1)
    for k in range(0, len(key), PART_BYTES):
        part = value[k : k + PART_BYTES]
        part &= ~low
        part |= np.arange(k, k + len(part), dtype=np.uint64)
    value.sort()
    value &= low
    order = value.view(np.int64)
    new, group, before, last = np.empty(len(key), bool), np.empty(len(key), np.int64), -1, None
    for k in range(0, len(key), PART_BYTES):
        part = slice(k, k + PART_BYTES)
        found = key.take(order[part])
        np.not_equal(found[1:], found[:-1], out=new[part][1:])
        new[k] = last is None or found[0] != last
        np.cumsum(new[part], out=group[part])
        group[part] += before
        before, last = group[part][-1], found[-1]
    return order, group, np.flatnonzero(new)


def words_in(data: np.ndarray, limits: np.ndarray) -> Words:
    low = lowered(data)
    starts, ends = word_limits(low, limits)
    row = np.repeat(np.arange(len(limits) - 1), np.diff(np.searchsorted(starts, limits)))
    spans = Spans(low)
    hashes = spans.hashes(starts, ends)
    order, group, first = side_by_side(hashes, hashes.copy())
    of = np.empty(len(order), np.int64)
    of[order] = group
    first = order[first]
    starts, sizes = starts[first], ends[first] - starts[first]
    begins = np.cumsum(sizes + 1) - sizes - 1
    inner = np.arange(int((sizes + 1).sum())) - np.repeat(begins, sizes + 1)
    place = np.repeat(starts, sizes + 1) + inner
    prefix = spans.sums.take(place)
    prefix -= np.repeat(spans.sums[starts], sizes + 1)
    prefix *= np.repeat(spans.inverses[starts], sizes + 1)
    coded = low.take(place, mode="clip") if len(place) else np.zeros(0, np.uint8)
    coded[begins + sizes] = BLANK
    return Words(row, hashes[first].view(np.int64), of, sizes, begins, coded, word_slot(prefix, inner))


def word_slot(prefix: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The slot of a word so far, by its hash and size; ``prefix`` is used up."""
    prefix += inner.astype(np.uint64)
    prefix *= np.uint64(0xBF58476D1CE4E5B9)
    prefix >>= np.uint64(64 - 16)
    return prefix.astype(np.int32)


def contexts(stream: np.ndarray, begins: np.ndarray, prefix: np.ndarray | None = None) -> list[np.ndarray]:
    """Slot of each of the three contexts at every byte; they never look past the places where texts begin.

    ``prefix`` has the slots of the words so far, if they are known.
    """
    n = len(stream)
    padded = np.concatenate([np.full(5, BLANK, np.uint8), stream])
    before = [padded[4 - k : n + 4 - k].copy() for k in range(5)]
    for k in range(5):  # the first bytes of a text have blanks before them
        near = (begins[:, None] + np.arange(k + 1)).ravel()
        before[k][near[near < n]] = BLANK
    three, five = np.empty(n, np.int32), np.empty(n, np.int32)
    for k in range(0, n, PART_BYTES):
        part = slice(k, k + PART_BYTES)
        x = before[0][part].astype(np.uint32) << np.uint32(16)
        x |= before[1][part].astype(np.uint32) << np.uint32(8)
        x |= before[2][part]
        y = before[3][part].astype(np.uint32) << np.uint32(8)
        y |= before[4][part]
        y *= np.uint32(0xC2B2AE35)
        y ^= x * np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x9E3779B1)
        x *= np.uint32(0x9E3779B1)
        three[part] = x >> np.uint32(32 - 14)
        five[part] = y >> np.uint32(32 - 16)
    if prefix is None:
        edges = np.concatenate([[0], np.flatnonzero(stream[:-1] == BLANK) + 1, [n]])
        sizes = np.diff(edges)
        prefix = word_slot(Spans(stream).prefixes(edges[:-1], sizes), np.arange(n) - np.repeat(edges[:-1], sizes))
    return [three, five, prefix]


def byte_tree(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code length of each byte, branch node and bit by depth, and the bytes on either side of each node."""
    heap = [(int(c) + 1, b, b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children.append((a[2], b[2]))
        heapq.heappush(heap, (a[0] + b[0], 256 + len(children), 255 + len(children)))
    sides = np.zeros((2, 256, 256), np.float32)
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    below: dict[int, list[int]] = {b: [b] for b in range(256)}
    for node, pair in enumerate(children):
        for bit, child in enumerate(pair):
            for b in below[child]:
                sides[bit, b, node] = 1
                paths[b].append((node, bit))
        below[256 + node] = below.pop(pair[0]) + below.pop(pair[1])
    length = np.array([len(p) for p in paths], np.uint8)
    nodes, bits = np.zeros((length.max(), 256), np.intp), np.zeros((length.max(), 256), np.float32)
    for b, path in enumerate(paths):
        for depth, (node, bit) in enumerate(reversed(path)):
            nodes[depth, b], bits[depth, b] = node, 2 * bit - 1
    return length, nodes, bits, sides


def byte_blocks(inside: np.ndarray) -> np.ndarray:
    """The block of each byte by its place in its text: blocks double in length up to the longest."""
    ends = [FIRST_BYTES]
    while ends[-1] < 2 * LAST_BYTES - FIRST_BYTES:
        ends.append(2 * ends[-1] + FIRST_BYTES)
    late = np.maximum(inside - ends[-1], 0) // LAST_BYTES
    return np.searchsorted(np.array(ends), inside, side="right").astype(np.int32) + late.astype(np.int32)


@dataclass
class Alike:
    """The bytes of a stream by what their costs rest on: the slots and the byte itself.

    ``order`` has the places of all bytes, longest codes first and equal ones side by side, and ``group`` the number
    of each one's group, in the same order; ``first`` has a place in the stream for every group. Equal bytes may
    rarely be in several groups, as they are sorted by a hash.
    """

    order: np.ndarray
    group: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.group, minlength=len(self.first))


def alike(stream: np.ndarray, slots: list[np.ndarray], length: np.ndarray) -> Alike:
    """The groups of equal slots and byte; ``length`` has the code length of each byte."""
    key, value = np.empty(len(stream), np.uint64), np.empty(len(stream), np.uint64)
    falling = np.uint64(255) - length.astype(np.uint64) << np.uint64(56)
    for k in range(0, len(stream), PART_BYTES):
        part = slice(k, k + PART_BYTES)
        key[part] = packed(stream[part], [s[part] for s in slots])
        x = np.multiply(key[part], BASE, out=value[part])
        x >>= np.uint64(24)
        # by the slot of the largest tables, so that they are read in order
        x |= slots[1][part].astype(np.uint64) << np.uint64(40)
        x |= falling.take(stream[part])
    order, group, first = side_by_side(key, value)
    return Alike(order, group, order[first])


class Refined:
    """How far each row has moved the weights of each gate, and what the bits since the last step teach.

    The squares of a byte's slopes stand for the curvature, which is their expectation.
    """

    def __init__(self, rows: int, inputs: int):
        self.rows = rows
        self.moved = np.zeros((inputs, GATES * rows), np.float32)
        self.slope = np.zeros(self.moved.shape)
        self.curve = np.full(self.moved.shape, FIRMNESS * SCALE * SCALE)

    def note(self, place: np.ndarray, slope: np.ndarray) -> None:
        """``place`` is the gate and row of each byte, gate by gate."""
        for i, x in enumerate(slope):
            self.slope[i] += np.bincount(place, x, self.slope.shape[1])
            self.curve[i] += np.bincount(place, x * x, self.slope.shape[1])

    def step(self, damping: float) -> None:
        self.moved += (damping * self.slope / self.curve).astype(np.float32)
        self.slope[:] = 0


@dataclass
class Branches:
    """The branches of groups of equal bytes, by depth, for the groups whose codes are that long.

    Each has the log-odds against the bit by the fitted weights, and those of each context.
    """

    gate: np.ndarray
    fitted: list[np.ndarray]
    inputs: list[list[np.ndarray]]

    def cost(self, group: np.ndarray, moved: list[np.ndarray] | None, slope: np.ndarray | None) -> np.ndarray:
        """Cost of bytes, given by their groups in rising order, so that the bytes with a branch at some depth are a
        slice; ``moved`` is added to their weights, and their slopes by each input are added to ``slope``."""
        loss, odd = np.zeros(len(group), np.float32), np.ones(len(group), np.float32)
        active = np.searchsorted(group, [len(f) for f in self.fitted]).tolist()
        for depth, (a, fitted, inputs) in enumerate(zip(active, self.fitted, self.inputs)):
            if not a:
                break
            z = fitted.take(group[:a])
            found = []
            if moved is not None or slope is not None:
                found = [x.take(group[:a]).astype(np.float32) for x in inputs]
            if moved is not None:
                for x, m in zip(found, moved):
                    z += x * m[:a]
            odds = np.exp(np.minimum(z, np.float32(40), out=z), out=z)
            whole = odds + np.float32(1)
            if slope is not None:
                error = np.divide(odds, whole, out=odds)
                for x, total in zip(found, slope):
                    x *= error
                    total[:a] -= x
            # one logarithm for two branches, whose product cannot overflow
            odd[:a] *= whole
            if depth % 2:
                loss[:a] += np.log(odd[:a], out=whole)
                odd[:a] = 1
        loss += np.log(odd, out=odd)
        return loss


@dataclass
class Mixer:
    length: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    tables: list[np.ndarray]
    known: list[np.ndarray]
    weights: np.ndarray  # depth, gate, input; the last input is a constant

    def gates(self, slots: list[np.ndarray]) -> np.ndarray:
        return self.known[-2][slots[-2]] * np.uint8(3) + self.known[-1][slots[-1]]

    def active(self, byte: np.ndarray) -> list[int]:
        """How many of the bytes have a branch at each depth."""
        return np.cumsum(np.bincount(self.length[byte], minlength=len(self.nodes) + 1)[:0:-1])[::-1].tolist()

    def branches(self, byte: np.ndarray, slots: list[np.ndarray]) -> Branches:
        """The branches of bytes that come by falling code length."""
        gate = self.gates(slots).astype(np.intp)
        byte, bases = byte.astype(np.intp), [s.astype(np.intp) * 256 for s in slots]  # places, so that no lookup converts them again
        sizes = [a for a in self.active(byte) if a]
        found = Branches(gate, [np.empty(a, np.float32) for a in sizes], [[np.empty(a, np.int8) for _ in self.tables] for a in sizes])
        weights, away = self.weights.transpose(0, 2, 1).copy(), -self.bits
        turned = away.astype(np.int8)
        for k in range(0, len(byte), PART_BYTES):
            for depth, a in enumerate(sizes):
                if a <= k:
                    break
                part = slice(k, min(k + PART_BYTES, a))
                at, of = byte[part], gate[part]
                node, turn = self.nodes[depth].take(at), turned[depth].take(at)
                z = weights[depth, -1].take(of) * away[depth].take(at)
                for i, table in enumerate(self.tables):
                    x = np.multiply(table.take(bases[i][part] + node), turn, out=found.inputs[depth][i][part])
                    z += x * weights[depth, i].take(of)
                found.fitted[depth][part] = z
        return found

    def cost(self, stream: np.ndarray, slots: list[np.ndarray], own: Refined | None = None, row: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithm of each byte's probability, negated.

        With the refined weights ``own`` of the rows, ``row`` says which row each byte is of, and what the bits
        teach is noted in ``own``.
        """
        found = alike(stream, slots, self.length)
        branches = self.branches(stream[found.first], [s[found.first] for s in slots])
        out = np.empty(len(stream), np.float32)
        out[found.order] = self.run_cost(branches, found.group, own, None if row is None else row[found.order], own is not None)
        return out

    def run_cost(
        self, branches: Branches, group: np.ndarray, own: Refined | None, row: np.ndarray | None, learn: bool, begun: bool = True
    ) -> np.ndarray:
        """Cost of bytes by their rising groups; noted in ``own`` if they are to ``learn`` from. Rows that have not
        ``begun`` to refine have the fitted weights."""
        if own is None or not (learn or begun):
            return branches.cost(group, None, None)
        place = branches.gate.take(group) * own.rows + row
        moved = [m.take(place) for m in own.moved] if begun else None
        slope = np.zeros((len(own.moved), len(group)), np.float32) if learn else None
        loss = branches.cost(group, moved, slope)
        if learn:
            own.note(place, slope)
        return loss

    def word_cost(self, words: Words, damping: float = DAMPING) -> np.ndarray:
        """The cost of every word and the blank behind it. All rows advance block by block, each by its own
        refined weights; a block of all rows is mixed part by part. A row's last block is not learned from."""
        stream, first, slots, begins = words.stream()
        if not len(stream):
            return np.zeros(0)
        found = alike(stream, slots, self.length)
        branches = self.branches(stream[found.first], [s[found.first] for s in slots])
        del slots
        own, long = Refined(len(begins), len(self.tables)), np.diff(np.append(begins, len(stream)))
        runs = 2 * byte_blocks(np.arange(long.max()))
        # small numbers are sorted by counting
        runs = runs.astype(np.uint16) if runs[-1] < 1 << 15 else runs
        run = runs.take(np.arange(len(stream)) - np.repeat(begins, long))
        run += run == np.repeat(runs[long - 1], long)
        row, sizes = np.repeat(np.arange(len(begins)), long), np.bincount(run)
        by_run = np.argsort(run.take(found.order), kind="stable")
        order, group = found.order.take(by_run), found.group.take(by_run)
        cost, end = np.empty(len(stream), np.float32), 0
        for number, size in enumerate(sizes.tolist()):
            at_block, is_last = divmod(number, 2)
            if at_block and not is_last:
                own.step(damping)
            begin, end = end, end + size
            for k in range(begin, end, PART_BYTES):
                part = slice(k, min(k + PART_BYTES, end))
                at = order[part]
                cost[at] = self.run_cost(branches, group[part], own, row[at], not is_last and damping > 0, at_block > 0)
        return np.add.reduceat(cost.astype(np.float64), first)


def packed(stream: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    """The slots and the byte that follows, in one number."""
    key = slots[0].astype(np.uint64) << np.uint64(40)
    key |= slots[1].astype(np.uint64) << np.uint64(24)
    key |= slots[2].astype(np.uint64) << np.uint64(8)
    key |= stream
    return key


def tuples(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The different slots and byte that follows, packed, of all bytes, and how often each occurs."""
    stream, _, slots, _ = words.stream()
    key = packed(stream, slots).view(np.int64)
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[new], np.diff(np.append(new, len(key)))


def unpacked(key: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    return [key >> 40, key >> 24 & 0xFFFF, key >> 8 & 0xFFFF], key & 255


def _log_odds(level: np.ndarray) -> np.ndarray:
    """The log-odds amid a level."""
    return (level * WIDTH + (WIDTH - 1) / 2 - WIDTH * LEVELS / 2) / SCALE


def solved(bits: np.ndarray, steps: int = 30, firmness: float = 1.0) -> np.ndarray:
    """The weights of greatest likelihood for tallied bits, by Newton steps for each depth and gate.

    A prior of ``firmness`` holds them near equal weights, which are those of a gate without bits.
    """
    depths, cells = len(bits), np.flatnonzero(bits)
    n = bits.ravel()[cells]
    group, rest = np.divmod(cells, 2 * LEVELS**3)
    bit, rest = np.divmod(rest, LEVELS**3)
    sign, groups = np.where(bit > 0, 1.0, -1.0), depths * GATES
    place = np.stack([rest // LEVELS**2, rest // LEVELS % LEVELS, rest % LEVELS])
    x = np.concatenate([_log_odds(place), np.ones((1, len(cells)))])
    start = np.array([*[START] * len(SLOTS), 0.0])
    weights = np.tile(start, (groups, 1))
    for _ in range(steps if len(cells) else 0):
        error = 1 / (1 + np.exp(np.clip(sign * (weights[group].T * x).sum(axis=0), -40, 40)))
        slope = np.stack([np.bincount(group, n * error * sign * r, groups) for r in x], axis=1) - firmness * (weights - start)
        bend, curve = n * error * (1 - error), np.zeros((groups, len(x), len(x)))
        for i in range(len(x)):
            for k in range(i + 1):
                curve[:, i, k] = curve[:, k, i] = np.bincount(group, bend * x[i] * x[k], groups)
        curve += firmness * np.eye(len(x))
        move = np.linalg.solve(curve, slope[:, :, None])[:, :, 0]
        weights += move / np.maximum(np.abs(move).max(axis=1, keepdims=True), 1.0)
    weights[:, :-1] /= SCALE
    return weights.reshape(depths, GATES, len(x)).astype(np.float32)


def _log_sigmoid(x: np.ndarray) -> np.ndarray:
    return -np.logaddexp(0, -x)


@dataclass
class Blend:
    """The last mixing step: a word as a whole, by its count, or byte by byte; the log-odds by its length."""

    keys: np.ndarray
    counts: np.ndarray
    tokens: int
    texts: int
    odds: np.ndarray

    @property
    def end(self) -> float:
        return min(max(self.texts / self.tokens, 1e-9), 1 - 1e-9) if self.tokens else 0.5

    def listed(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The place of every different word in the list, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(words.keys), np.int64), np.zeros(len(words.keys), bool)
        slot = np.minimum(np.searchsorted(self.keys, words.keys), len(self.keys) - 1)
        return slot, self.keys[slot] == words.keys

    def parts(self, words: Words, own: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of every different word by its length, and its log probability, -inf where it is not listed."""
        found = np.full(len(words.keys), -np.inf)
        slot, known = self.listed(words)
        if len(self.keys):
            known = known & (self.counts[slot] > own)
            found[known] = np.log((self.counts[slot[known]] - own) / max(self.tokens - self.texts, 1))
        return np.minimum(words.sizes, len(self.odds)) - 1, found

    def cost(self, words: Words, by_bytes: np.ndarray, rows: int, step: float) -> tuple[np.ndarray, np.ndarray]:
        """Cost of every row, end included; all rows advance block by block and refine their log-odds.

        Words that are not listed cost their bytes here. The second result is for every word how many times,
        as a logarithm, its coding as a whole outweighs that by bytes, but for the word's own probability.
        """
        bucket, whole = self.parts(words)
        count = np.bincount(words.row, minlength=rows)
        block = (np.arange(len(words.row)) - (np.cumsum(count) - count)[words.row]) // BLOCK
        order = np.argsort(block, kind="stable")
        limits = np.searchsorted(block[order], np.arange(int(block.max(initial=-1)) + 2))
        shift, total = np.zeros(rows), -np.log(self.end) - count * np.log1p(-self.end)
        lift = np.empty(len(words.row))
        for begin, end in zip(limits[:-1], limits[1:]):
            at = order[begin:end]
            of, row = words.of[at], words.row[at]
            odds = self.odds[bucket[of]] + shift[row]
            share = _log_sigmoid(odds)
            a, b = share + whole[of], share - odds - by_bytes[at]
            both = np.logaddexp(a, b)
            lift[at] = odds + by_bytes[at]
            total -= np.bincount(row, both, rows)
            if end < len(order) and step:
                slope = np.exp(a - both) - 1 / (1 + np.exp(-odds))
                shift += step * np.bincount(row, slope, rows) / np.maximum(np.bincount(row, minlength=rows), 1)
        return total, lift


@dataclass
class Tally:
    """What the training texts tell of the weights and the shares, as counts that add up over tasks.

    ``bits`` has for each depth and gate the bits by the bit itself and by the level of each context's log-odds, in which
    the bit's own count is taken off. ``words`` has for each length the words by the log-odds of the whole word
    against its bytes, its own count taken off as well; the first bin is for words without other copies.
    """

    bits: np.ndarray
    words: np.ndarray

    @classmethod
    def empty(cls, mixer: Mixer) -> Tally:
        return cls(np.zeros((len(mixer.nodes), GATES, 2 * LEVELS**3), np.int64), np.zeros((LENGTHS, BINS), np.int64))

    def add(self, mixer: Mixer, levels: list[np.ndarray], blend: Blend, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``levels`` has for each context's cells and either bit the level of the log-odds without one count of it. The
        cost of bytes is that by equal weights, as the fitted ones come of this tally. Returned are the words that
        ``blend`` does not list: their keys, places of their lengths and costs."""
        stream, first, slots, _ = words.stream()
        if not len(stream):
            return words.keys, words.of, np.zeros(0)
        cost = np.empty(len(stream), np.float32)
        place = np.arange(2 * LEVELS**3)
        away = START * sum(_log_odds(x) for x in (place // LEVELS**2 % LEVELS, place // LEVELS % LEVELS, place % LEVELS))
        costs = np.logaddexp(0, np.where(place < LEVELS**3, away, -away)).astype(np.float32)
        branch = 2 * mixer.nodes + (mixer.bits > 0)
        found = alike(stream, slots, mixer.length)
        times, slots = found.counts, [s[found.first] for s in slots]
        gate = mixer.gates(slots).astype(np.intp) * len(costs)
        byte, bases = stream[found.first].astype(np.intp), [s.astype(np.intp) * 512 for s in slots]
        loss = np.zeros(len(byte), np.float32)
        active = mixer.active(byte)
        for k in range(0, len(byte), PART_BYTES):
            for depth, a in enumerate(active):
                if a <= k:
                    break
                part = slice(k, min(k + PART_BYTES, a))
                node = branch[depth].take(byte[part])
                cell = (node & 1).astype(np.uint16)
                for base, level in zip(bases, levels):
                    cell *= np.uint16(LEVELS)
                    cell += level.take(base[part] + node)
                cell = cell.astype(np.intp)
                loss[part] += costs.take(cell)
                cell += gate[part]
                np.add.at(self.bits[depth].reshape(-1), cell, times[part])
        cost[found.order] = loss.take(found.group)
        by_bytes = np.add.reduceat(cost.astype(np.float64), first)
        bucket, whole = blend.parts(words, own=1)
        listed, bucket = blend.listed(words)[1][words.of], bucket[words.of]
        odds = whole[words.of] + by_bytes
        place = np.where(np.isfinite(odds), np.clip((odds + LEAST_ODDS) * BINS_NAT, 1, BINS - 1), 0).astype(np.int64)
        self.words += np.bincount((bucket * BINS + place)[listed], minlength=self.words.size).reshape(self.words.shape)
        return words.keys[words.of[~listed]], bucket[~listed], by_bytes[~listed]

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The cells that occur, numbered through, and their counts."""
        whole = np.concatenate([self.bits.ravel(), self.words.ravel()])
        cells = np.flatnonzero(whole)
        return cells, whole[cells]


def tallied(training: DataFrame, mixer: Mixer, levels: list[np.ndarray], blend: Blend, counts: DataFrame | None) -> Tally:
    """The tally of all training texts; words that ``blend`` does not list are joined with their ``counts``."""
    small, joined = sent(levels), counts is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, levels = Tally.empty(mixer), received(small, np.uint8)
        for batch in batches:
            for _, _, data, limits in _chunks(batch, 0):
                word, size, cost = tally.add(mixer, levels, blend, words_in(data, limits))
                if joined:
                    yield batch_of(
                        cell=pa.array(size, pa.int64()), n=pa.nulls(len(size), pa.int64()), word=pa.array(word, pa.int64()), cost=pa.array(cost, pa.float64())
                    )
        cells, n = tally.rows()
        yield batch_of(
            cell=pa.array(cells, pa.int64()), n=pa.array(n, pa.int64()), word=pa.nulls(len(n), pa.int64()), cost=pa.nulls(len(n), pa.float64())
        )

    found = _few(training).mapInArrow(work, "cell long, n long, word long, cost double")
    tally = Tally.empty(mixer)
    if joined:
        found = materialise(found, "tally")
        odds = F.log((F.col("of.n") - 1) / F.lit(float(max(blend.tokens - blend.texts, 1)))) + F.col("cost")
        place = F.greatest(F.lit(1.0), F.least(F.lit(BINS - 1.0), (odds + LEAST_ODDS) * BINS_NAT)).cast("long")
        place = F.when(F.col("of.n") > 1, place).otherwise(F.lit(0))
        rare = found.filter("n IS NULL").join(counts.alias("of"), F.col("word") == F.col("of.key"))
        rare = rare.groupBy((F.col("cell") * BINS + place).alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
        tally.words.ravel()[rare.column("cell").to_numpy()] = rare.column("n").to_numpy()
    sums = found.filter("n IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, n = sums.column("cell").to_numpy(), sums.column("n").to_numpy()
    inner = cells < tally.bits.size
    tally.bits.ravel()[cells[inner]] = n[inner]
    tally.words.ravel()[cells[~inner] - tally.bits.size] += n[~inner]
    return tally


def shares(tally: Tally, passes: int = 50) -> np.ndarray:
    """Log-odds of coding a word as a whole, by its length, by expectation maximisation over the tallied words."""
    value = (np.arange(BINS) + 0.5) / BINS_NAT - LEAST_ODDS
    odds, total = np.zeros((LENGTHS, 1)), tally.words.sum(axis=1, keepdims=True)
    for _ in range(passes):
        whole = 1 / (1 + np.exp(np.minimum(-odds - value, 700.0)))
        whole[:, 0] = 0
        share = np.clip(((tally.words * whole).sum(axis=1, keepdims=True) + 1) / (total + 2), 0.001, 0.999)
        odds = np.log(share / (1 - share))
    return odds[:, 0]


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, limits = text_buffer(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(limits, limits[begin] + CHUNK_BYTES, side="right")) - 1)
        yield begin, end, data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin]
        begin = end


def sent(tables: list[np.ndarray]) -> list[tuple[bytes, int]]:
    """Tables of bytes as they go with the tasks, so that no executor keeps them at their full size on its disk."""
    return [(pa.compress(memoryview(t), codec="zstd", asbytes=True), len(t)) for t in tables]


def received(tables: list[tuple[bytes, int]], kind: type) -> list[np.ndarray]:
    return [np.frombuffer(pa.decompress(t, size, codec="zstd"), kind) for t, size in tables]


def _few(training: DataFrame) -> DataFrame:
    """The texts in fewer tasks: each brings its counts once for all its texts, so a few splits go to one."""
    splits = training.rdd.getNumPartitions()
    return training.select("text").coalesce(max(training.sparkSession.sparkContext.defaultParallelism, splits // SPLITS))


def gathered(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts over all training texts: bytes by context slot, and words by hash with their length, which is
    ``LENGTHS`` for the end and one less for words of that many bytes or more; written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(s * 256, np.uint32) for s in SLOTS]  # of one task; sums beyond are longs
        for batch in batches:
            found, counts, kinds = [np.array([END_WORD])], [np.array([batch.num_rows])], [np.array([LENGTHS])]
            for _, _, data, limits in _chunks(batch, 0):
                words = words_in(data, limits)
                found.append(words.keys)
                counts.append(np.bincount(words.of, minlength=len(words.keys)))
                kinds.append(np.minimum(words.sizes, LENGTHS) - 1)
                key, n = tuples(words)
                slots, byte = unpacked(key)
                for total, slot in zip(totals, slots):
                    np.add.at(total, slot * 256 + byte, n.astype(np.uint32))
            values, place, of = np.unique(np.concatenate(found), return_index=True, return_inverse=True)
            n = np.bincount(of, np.concatenate(counts)).astype(np.int64)
            yield batch_of(kind=pa.array(np.concatenate(kinds)[place], pa.int32()), key=values, n=n)
        cells = [np.flatnonzero(t) for t in totals]
        keys = np.concatenate([c + OFFSETS[i] * 256 for i, c in enumerate(cells)])
        n = np.concatenate([t[c] for t, c in zip(totals, cells)]).astype(np.int64)
        yield batch_of(kind=pa.array(np.full(len(n), -1), pa.int32()), key=keys, n=n)

    counts = _few(training).mapInArrow(work, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "counts")
    return counts.filter("kind < 0").select("key", "n"), counts.filter("kind >= 0").select("key", "n", F.col("kind").alias("size"))


def words_of(sample: pa.ChunkedArray) -> Words:
    return words_in(*text_buffer(sample if len(sample) else pa.array([""])))


def _quantised(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    value = np.log((ones + PRIOR) / (zeros + PRIOR)) * SCALE
    return np.clip(value, -127, 127).round().reshape(-1)


def fitted(counts: DataFrame, blend: Blend, learned: DataFrame | Words, rare: DataFrame | None = None) -> Mixer:
    """The mixer from the gathered counts, at most 256 for each slot; its weights, and the shares of ``blend``,
    fitted on all that was ``learned``: a table of texts, or words at hand. ``rare`` has the counts
    of the words that ``blend`` does not list, if there are any. One context's counts are in memory at a time.
    """
    odds, known, levels, tree = [], [], [], None
    for i, size in enumerate(SLOTS):
        found = counts.filter(F.col("key").between(OFFSETS[i] * 256, OFFSETS[i + 1] * 256 - 1)).toArrow()
        table = np.zeros(size * 256, np.float32)
        table[found.column("key").to_numpy() - OFFSETS[i] * 256] = found.column("n").to_numpy()
        del found
        table = table.reshape(-1, 256)
        tree = tree or byte_tree(table.sum(axis=0, dtype=np.float64))
        sides = tree[3]
        values, level = np.empty(table.size, np.int8), np.empty((table.size, 2), np.uint8)
        for k in range(0, size, 4096):
            part = table[k : k + 4096]
            ones, zeros = part @ sides[1], part @ sides[0]
            own = np.maximum(zeros - 1, 0), np.maximum(ones - 1, 0)
            at = slice(k * 256, k * 256 + part.size)
            values[at] = _quantised(ones, zeros)
            level[at, 0] = (_quantised(ones, own[0]) + WIDTH * LEVELS // 2) // WIDTH
            level[at, 1] = (_quantised(own[1], zeros) + WIDTH * LEVELS // 2) // WIDTH
        odds.append(values)
        levels.append(level.reshape(-1))
        known.append(np.digitize(table.sum(axis=1), [1, 64]).astype(np.uint8))
        del table, part
    mixer = Mixer(*tree[:3], odds, known, np.zeros(0))
    if isinstance(learned, Words):
        tally = Tally.empty(mixer)
        tally.add(mixer, levels, blend, learned)
    else:
        # the tasks that tally need no log-odds
        tally = tallied(learned, replace(mixer, tables=[]), levels, blend, rare)
    mixer.weights = solved(tally.bits)
    blend.odds = shares(tally)
    return mixer


def scored(
    docs: DataFrame, training: Column, top_words: int = TOP_WORDS, step: float = STEP, damping: float = DAMPING
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` of every document.

    ``training`` is a condition on the rows to learn from. ``base_score`` is the unigram's and ``score`` the
    mixer's log10 probability; ``bits_per_byte`` is the mixer's cost for each normalised byte. A null text
    counts as empty and is its end alone. Rows that repeat id and text count once; a null id stays null. With
    nothing to learn from, all counts are 0 and every bit has even odds. Other columns are ignored; an empty
    table gives an empty result. ``step`` and ``damping`` are the sizes of a text's own refinements, of its
    share of whole words and of its gated weights; 0 leaves them as fitted. The most frequent words are taken
    in the order of the counts, ties by key. Nothing is fitted on a sample.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learned = docs.filter(training).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bytes_by_slot, words = gathered(learned)
    by_size = words.groupBy(F.col("size") == LENGTHS).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    tokens, distinct = sum(r.n for r in by_size), sum(r.words for r in by_size)
    texts = sum(r.n for r in by_size if r[0])
    top = words.select("key", "n").orderBy(F.desc("n"), "key").limit(top_words).toArrow().sort_by("key")
    top_key, top_n = top.column("key").to_numpy(), top.column("n").to_numpy()
    blend = Blend(top_key, top_n, tokens, texts, np.zeros(LENGTHS))
    mixer = fitted(bytes_by_slot, blend, learned, words if distinct > len(top_n) else None)
    tables, bare = sent(mixer.tables), replace(mixer, tables=[])
    del mixer
    least = np.append(np.log10((top_n + 0.1) / (tokens + 0.1 * (distinct + 1))), 0.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = replace(bare, tables=received(tables, np.int8))
        for batch in batches:
            for begin, end, data, limits in _chunks(batch, 1):
                n = end - begin
                words = words_in(data, limits)
                cost, lift = blend.cost(words, mixer.word_cost(words, damping), n, step)
                n_bytes = np.bincount(words.row, words.sizes[words.of] + 1, n) + 1
                keys, of, row = np.append(words.keys, END_WORD), words.of, words.row
                slot = np.minimum(np.searchsorted(top_key, keys), max(len(top_key) - 1, 0))
                known = top_key[slot] == keys if len(top_key) else np.zeros(len(keys), bool)
                value = np.where(known, least[slot], 0.0)
                rare = np.concatenate([np.flatnonzero(~known[of]), np.arange(len(of), len(of) + n * (not known[-1]))]).astype(np.int64)
                of, row = np.append(of, np.full(n, len(keys) - 1)), np.append(row, np.arange(n))
                lift = np.append(lift, np.full(n, -np.inf))  # the end is no word to be coded by bytes
                rare = rare[np.argsort(row[rare], kind="stable")]
                counts = np.bincount(row[rare], minlength=n)
                yield batch_of(
                    doc_id=batch.column(0).slice(begin, n), key=batch.column(2).slice(begin, n),
                    n_tokens=np.bincount(row, minlength=n), n_top=np.bincount(row, known[of], n).astype(np.int64),
                    base=np.bincount(row, value[of], n), cost=cost, n_bytes=n_bytes.astype(np.int64),
                    rare=pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(keys[of[rare]]), pa.array(lift[rare], pa.float32())], ["word", "lift"]),
                    ),
                )

    schema = "doc_id long, key long, n_tokens long, n_top long, base double, cost double, n_bytes long, rare array<struct<word: long, lift: float>>"
    found = materialise(rows.withColumn("key", F.xxhash64("text")).mapInArrow(work, schema), "scored")
    each = found.select("doc_id", "key", F.inline("rare")).join(words.select(F.col("key").alias("word"), "n"), "word", "left")
    term = F.log10((F.coalesce("n", F.lit(0)) + 0.1) / F.lit(tokens + 0.1 * (distinct + 1)))
    # what a word saves that is coded as a whole as well as by its bytes: log(1 + e^x)
    x = F.col("lift").cast("double") + F.log(F.col("n") / F.lit(float(max(tokens - texts, 1))))
    saved = F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
    rest = each.groupBy(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key")).agg(
        F.sum(term).alias("rest"), F.count("n").alias("n_rest"), F.sum(saved).alias("saved")
    )
    # repeated rows bring their rare words once each, so their sums are shared out
    once = found.groupBy("doc_id", "key").agg(
        F.count(F.lit(1)).alias("m"), *[F.first(c).alias(c) for c in ("n_tokens", "n_top", "base", "cost", "n_bytes")]
    )
    both = once.join(rest, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    log10 = float(np.log(10))
    both = both.withColumn("cost", F.col("cost") - F.coalesce(F.col("saved") / F.col("m"), F.lit(0.0)))
    return both.select(
        "doc_id", "n_tokens",
        (F.col("n_top") + F.coalesce(F.col("n_rest") / F.col("m"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("rest") / F.col("m"), F.lit(0.0))).alias("base_score"),
        (-F.col("cost") / log10).alias("score"),
        (F.col("cost") / float(np.log(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
