"""Repeated passages by enhanced suffix arrays over a sparse set of suffixes.

Every window of ``LENGTH`` bytes holds an anchor: the place whose ``GRAM`` bytes have the lowest hash in
the window. Equal windows have equal anchors, so two suffixes need comparing only where an anchor's
bytes repeat, and only within a frame, the bytes of the windows that the anchor belongs to. A repeat of
``LENGTH`` bytes or more is covered by the frames of its anchors.

The suffixes of one anchor value form a group. A task sorts the suffixes of many groups at once, with
the common prefixes of neighbours beside them, and a stack scan of these gives the tree of
common-prefix intervals. Within an interval the bytes to the left are scanned likewise; where a left
extension first differs, the occurrences below it are a maximal repeat of the frame. The first occurrence
of each stays, all others are covered. Frames that are equal as a whole are combined before the
shuffle. Anchor values with more than ``GROUP_ROWS`` occurrences go another, equally exact way: their
windows are hashed and the first of each hash found by an aggregate with partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Spans, batch_of, lean, mixed, row_of, text_buffer
from feedloom.session import materialise

LENGTH = 100
GRAM = 24
LEFT = LENGTH - GRAM
#: Suffixes of one anchor value that one task sorts together.
GROUP_ROWS = 5_000
CHUNK_BYTES = 500_000
#: Frames of hot anchors whose windows are hashed at a time.
HOT_FRAMES = 5_000
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Lowest of each ``width`` values in a row, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, TOP)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place, as three words of 8 bytes."""
    n = len(data) - GRAM + 1
    words = np.ndarray(n + 16, "<u8", data, strides=(1,))
    found = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    found ^= found >> np.uint64(29)
    found += words[8 : n + 8]
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    found += words[16:]
    found *= np.uint64(0x94D049BB133111EB)
    found ^= found >> np.uint64(31)
    return found * np.uint64(0xD6E8FEB86659FD93)


def anchors(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The anchors of all rows: row, place, hash, and the first and last window that each is the anchor of.

    A window's anchor is its leftmost place of lowest hash. Rows shorter than a window have none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, np.zeros(0, np.uint64), none, none
    grams = gram_hashes(np.ascontiguousarray(data))
    order = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    lowest = (sliding_minimum(order, LEFT + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    for end in limits[1:].tolist():
        lowest[max(end - LENGTH + 1, 0) : end] = -1
    first = np.flatnonzero(np.append(True, lowest[1:] != lowest[:-1]))
    last = np.append(first[1:], len(lowest)) - 1
    fine = lowest[first] >= 0
    first, last = first[fine], last[fine]
    place = lowest[first]
    return row_of(limits, place), place, grams[place], first, last


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, limits = text_buffer(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(limits, limits[begin] + CHUNK_BYTES, side="right")) - 1)
        yield begin, end, data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin]
        begin = end


def anchor_rows(docs: DataFrame) -> DataFrame:
    """``(h, doc_id, n)``: anchor values of every document and how often it holds each."""

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for begin, end, data, limits in _chunks(batch, 1):
                row, _, h, _, _ = anchors(data, limits)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(row)))
                yield batch_of(h=h[first].view(np.int64), doc_id=ids[begin:end][row[first]], n=n.astype(np.int64))

    return docs.select("doc_id", "text").mapInArrow(work, "h long, doc_id long, n long")


def repeated_anchors(found: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(doc_id, x)`` of the anchor values that stand in more than one place; ``x`` is ``(h, hot)``.

    A value is hot with more than ``group_rows`` occurrences, however they are dealt to documents, so no
    group of frames that one task sorts is larger.
    """
    counts = found.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    hot = (F.col("n") > group_rows).alias("hot")
    return found.select("h", "doc_id").join(counts, "h").select("doc_id", F.struct("h", hot).alias("x"))


def _interval_scan(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The tree of common-prefix intervals ``(depth, first, last)``, children before parents.

    ``common[i]`` is the common prefix of entries ``i - 1`` and ``i``; intervals shallower than ``least``
    are left out.
    """
    stack = [(0, 0)]
    for i in range(1, len(common) + 1):
        depth = common[i] if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            if top >= least and first < i - 1:
                yield top, first, i - 1
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))


def repeats_of_group(right: list[int], left_rank: list[int], left: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats ``(left, right, members)`` among the suffixes of one group.

    Members are numbered in order of their suffix. ``right[i]`` is the common prefix of suffixes ``i - 1``
    and ``i``; ``left_rank`` is each member's place in the order of the reversed left contexts, and
    ``left[r]`` the common left extension of places ``r - 1`` and ``r``.
    """
    for depth, first, last in _interval_scan(right, GRAM):
        members = sorted(range(first, last + 1), key=left_rank.__getitem__)
        ranks = [left_rank[m] for m in members]
        common = [0] + [min(left[a + 1 : b + 1]) for a, b in zip(ranks, ranks[1:])]
        need = LENGTH - min(depth, LENGTH)
        if need == 0 and len(members) > 1 and min(common[1:]) == 0:
            yield 0, depth, members
        for extension, low, high in _interval_scan(common, max(need, 1)):
            yield extension, depth, members[low : high + 1]


def _sorted_contexts(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order within groups and the common prefix of neighbours, 0 across groups."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words = padded.view(">u8")
    order = np.lexsort((tie, sizes, *[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], group))
    one, two = rows[order[1:]], rows[order[:-1]]
    differs = one != two
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    common = np.minimum(common, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    common[group[order[1:]] != group[order[:-1]]] = 0
    return order, np.concatenate([[0], common])


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, limits = text_buffer_of_binary(column)
    sizes = np.diff(limits)
    out = np.zeros((len(sizes), width), np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(data)) - limits[:-1][row]] = data
    return out, sizes


def text_buffer_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    limits = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    if data is None or limits[-1] == limits[0]:
        return np.zeros(0, np.uint8), limits - limits[0]
    return np.frombuffer(data, np.uint8)[limits[0] : limits[-1]], limits - limits[0]


def _earliest(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the number of the first of its key by document and place, and whether it stands later."""
    order = np.lexsort((place, doc, key))
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    lead = np.empty(len(key), np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    return lead, (doc != doc[lead]) | (place != place[lead])


def frame_repeats(h: np.ndarray, doc: np.ndarray, place: np.ndarray, left: pa.Array, right: pa.Array) -> tuple[np.ndarray, ...]:
    """Repeats among the frames of complete groups: arrays ``(group, member row, left, right, first row)``.

    A group number stands for one maximal repeat; its rows are all its occurrences, by their anchors.
    """
    lefts, left_sizes = _matrix(left, LEFT)
    rights, right_sizes = _matrix(right, LENGTH)
    group = np.unique(h, return_inverse=True)[1]
    tie = np.zeros(len(h), np.int64)
    order, common = _sorted_contexts(rights, right_sizes, group, tie)
    left_order, left_common = _sorted_contexts(lefts, left_sizes, group, tie)
    # frames that are equal on both sides are one member
    right_class = np.empty(len(h), np.int64)
    right_class[order] = np.cumsum(~_equal_neighbours(order, common, right_sizes, group))
    left_class = np.empty(len(h), np.int64)
    left_class[left_order] = np.cumsum(~_equal_neighbours(left_order, left_common, left_sizes, group))
    same = np.unique(right_class * (len(h) + 1) + left_class, return_inverse=True)[1]
    lead, later = _earliest(same, doc, place)
    out = []
    whole = np.flatnonzero(np.bincount(same)[same] > 1)
    whole = whole[right_sizes[whole] + left_sizes[whole] >= LENGTH]
    out.append((same[whole], whole, left_sizes[whole], right_sizes[whole], lead[whole]))
    chosen = np.unique(lead)
    count = np.bincount(group[chosen], minlength=group.max() + 1 if len(group) else 0)
    chosen = chosen[count[group[chosen]] > 1]
    if len(chosen):
        chosen = chosen[np.argsort(group[chosen], kind="stable")]
        g = group[chosen]
        order, common = _sorted_contexts(rights[chosen], right_sizes[chosen], g, np.arange(len(chosen)))
        left_order, left_common = _sorted_contexts(lefts[chosen], left_sizes[chosen], g, np.arange(len(chosen)))
        left_rank = np.empty(len(chosen), np.int64)
        left_rank[left_order] = np.arange(len(chosen))
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        last = np.append(first[1:], len(g))
        number = len(h)
        rank, common_list, left_list, order_list = left_rank[order].tolist(), common.tolist(), left_common.tolist(), order.tolist()
        position = list(zip(doc[chosen].tolist(), place[chosen].tolist()))
        rows: list[tuple[int, int, int, int, int]] = []
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a == 2 and common_list[a + 1] + left_list[a + 1] < LENGTH:
                continue
            shifted = [r - a for r in rank[a:b]]
            for extension, depth, members in repeats_of_group([0] + common_list[a + 1 : b], shifted, [0] + left_list[a + 1 : b]):
                names = [order_list[a + m] for m in members]
                head = min(names, key=position.__getitem__)
                rows.extend((number, name, extension, depth, head) for name in names)
                number += 1
        if rows:
            found = np.array(rows, np.int64)
            out.append((found[:, 0], chosen[found[:, 1]], found[:, 2], found[:, 3], chosen[found[:, 4]]))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(5))


def _equal_neighbours(order: np.ndarray, common: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether each sorted entry equals the one before it in group, bytes and length."""
    equal = np.zeros(len(order), bool)
    one, two = order[1:], order[:-1]
    equal[1:] = (group[one] == group[two]) & (sizes[one] == sizes[two]) & (common[1:] == sizes[one])
    return equal


FRAMES = "kind int, h long, g long, doc_id long, place long, before int, after int, left_part binary, right_part binary"


def _pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray, reverse: bool = False) -> pa.Array:
    sizes = end - begin
    ends = np.cumsum(sizes)
    inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    at = np.repeat(end - 1, sizes) - inner if reverse else np.repeat(begin, sizes) + inner
    limits = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(limits), pa.py_buffer(np.ascontiguousarray(data[at]))])


def frames(candidates: DataFrame) -> DataFrame:
    """Frames of the repeated anchors of ``(doc_id, text, hs, hot)``.

    Kind 0 is a frame to compare, kind 1 a span that an equal frame before it in this task covers, kind 2
    a window around a hot anchor as 128 bits of hash.
    """

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            names = batch.schema.names
            lists = batch.column(names.index("hs"))
            known_row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            known_h = flat.field("h").to_numpy().view(np.uint64)
            known_hot = flat.field("hot").to_numpy(zero_copy_only=False)
            for begin, end, data, limits in _chunks(batch, 1):
                row, place, h, first, last = anchors(data, limits)
                mine = (known_row >= begin) & (known_row < end)
                key = mixed(known_h[mine] ^ mixed((known_row[mine] - begin).astype(np.uint64)))
                order = np.argsort(key)
                key, hot_of = key[order], known_hot[mine][order]
                own = mixed(h ^ mixed(row.astype(np.uint64)))
                slot = np.minimum(np.searchsorted(key, own), max(len(key) - 1, 0))
                fits = key[slot] == own if len(key) else np.zeros(len(own), bool)
                row, place, h, before, after = row[fits], place[fits], h[fits], first[fits], last[fits] + LENGTH
                hot = hot_of[slot[fits]] if len(key) else np.zeros(0, bool)
                doc, at = ids[begin:end][row], place - limits[row]
                spans = Spans(data)
                whole = mixed(spans.hashes(before, after) ^ mixed((place - before).astype(np.uint64)))
                lead, alike = _earliest(whole, doc, at)
                again = np.flatnonzero(alike)
                alike[again] = _same_bytes(data, before[again], after[again], before[lead[again]], after[lead[again]])
                yield _frame_batch(1, h[alike], None, doc[alike], at[alike], (place - before)[alike], (after - place)[alike], None, None)
                rest = ~alike
                hot_rows, cool = np.flatnonzero(rest & hot), np.flatnonzero(rest & ~hot)
                yield _frame_batch(
                    0, h[cool], None, doc[cool], at[cool], (place - before)[cool], (after - place)[cool],
                    _pieces(data, before[cool], place[cool], reverse=True), _pieces(data, place[cool], after[cool]),
                )
                backwards = Spans(data[::-1].copy()) if len(hot_rows) else None
                for k in range(0, len(hot_rows), HOT_FRAMES):
                    part = hot_rows[k : k + HOT_FRAMES]
                    count = after[part] - before[part] - LENGTH + 1
                    start = np.repeat(before[part], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    of = row_of(limits, start)
                    second = backwards.hashes(len(data) - start - LENGTH, len(data) - start)
                    yield _frame_batch(
                        2, spans.hashes(start, start + LENGTH), second, ids[begin:end][of], start - limits[of],
                        np.zeros(len(start)), np.full(len(start), LENGTH), None, None,
                    )

    return candidates.mapInArrow(work, FRAMES)


def _same_bytes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, other: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Whether the two spans of each entry hold the same bytes."""
    equal = (end - begin) == (other_end - other)
    for k in range(LEFT + LENGTH):
        at = np.flatnonzero(equal & (begin + k < end))
        if not len(at):
            break
        equal[at] = data[begin[at] + k] == data[other[at] + k]
    return equal


def _frame_batch(kind, h, g, doc, place, before, after, left, right) -> pa.RecordBatch:
    n = len(h)
    blank = lambda: pa.nulls(n, pa.binary())
    return batch_of(
        kind=pa.array(np.full(n, kind), pa.int32()), h=np.ascontiguousarray(h).view(np.int64),
        g=pa.nulls(n, pa.int64()) if g is None else np.ascontiguousarray(g).view(np.int64),
        doc_id=doc, place=place.astype(np.int64), before=pa.array(before, pa.int32()), after=pa.array(after, pa.int32()),
        left_part=blank() if left is None else left, right_part=blank() if right is None else right,
    )


def maximal_repeats(frame_rows: DataFrame) -> DataFrame:
    """``(kind, repeat_id, h, g, doc_id, start, end, first)`` from frames: all occurrences of each repeat.

    Frames of kind 0 give rows of kind 0, one for each occurrence of a maximal repeat; ``first`` marks the
    earliest. A repeat reaches as far as the frame around its anchor, so a longer one comes as overlapping
    repeats of its several anchors. Rows of the other kinds pass as they are, dealt to all tasks.
    """
    key = F.when(F.col("kind") == 0, F.col("h")).otherwise(F.xxhash64("doc_id", "place"))
    dealt = frame_rows.withColumn("key", key).repartition("key").sortWithinPartitions("kind", "key")

    def passed(table: pa.Table) -> pa.RecordBatch:
        part = {c: table.column(c).combine_chunks() for c in table.column_names}
        n, place = table.num_rows, part["place"].to_numpy()
        return batch_of(
            kind=part["kind"], repeat_id=pa.nulls(n, pa.int64()), h=part["h"], g=part["g"], doc_id=part["doc_id"],
            start=place - part["before"].to_numpy(), end=place + part["after"].to_numpy(), first=np.zeros(n, bool),
        )

    def solved(table: pa.Table) -> pa.RecordBatch:
        part = {c: table.column(c).combine_chunks() for c in table.column_names}
        h, doc, place = (part[c].to_numpy() for c in ("h", "doc_id", "place"))
        group, row, left, right, head = frame_repeats(h, doc, place, part["left_part"], part["right_part"])
        name = mixed(h[row].view(np.uint64) ^ mixed(group.astype(np.uint64))).view(np.int64)
        first = (doc[row] == doc[head]) & (place[row] == place[head])
        return batch_of(
            kind=np.zeros(len(row), np.int32), repeat_id=name, h=h[row], g=pa.nulls(len(row), pa.int64()), doc_id=doc[row],
            start=place[row] - left, end=place[row] + right, first=first,
        )

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            compare = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if compare < batch.num_rows:
                yield passed(pa.Table.from_batches([batch.slice(compare)]))
            if not compare:
                continue
            table = pa.Table.from_batches([batch.slice(0, compare)] if rest is None else [*rest.to_batches(), batch.slice(0, compare)]).combine_chunks()
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield solved(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
        if rest is not None:
            yield solved(rest)

    return dealt.drop("key").mapInArrow(
        work, "kind int, repeat_id long, h long, g long, doc_id long, start long, end long, first boolean"
    )


def text_hash(text: str = "text"):
    return F.struct(F.xxhash64(text).alias("h"), F.hash(text).alias("g"), F.length(F.col(text).cast("binary")).alias("n"))


def covered(docs: DataFrame, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """All documents, and the texts of those of which bytes are to go.

    The first is ``(doc_id, n_bytes, sha256, copy)`` with one row per id, where ``copy`` says that a smaller
    id has the same text. The second is ``(doc_id, text, spans)`` of texts that are no copies.
    """
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    facts = rows.select("doc_id", text_hash().alias("key"), F.sha2("text", 256).alias("sha256"))
    facts = materialise(facts.groupBy("doc_id").agg(F.min(F.struct("key", "sha256")).alias("x")).select("doc_id", "x.*"), "facts")
    leads = materialise(facts.groupBy("key").agg(F.min("doc_id").alias("lead")), "leads")
    every = facts.join(leads, "key").select(
        "doc_id", F.col("key.n").cast("long").alias("n_bytes"), "sha256", (F.col("doc_id") != F.col("lead")).alias("copy")
    )
    found = anchor_rows(rows.filter(F.length("text") >= LENGTH // 4))
    repeated = repeated_anchors(found, group_rows)
    wanted = materialise(
        repeated.groupBy("doc_id").agg(F.collect_list("x").alias("hs")).join(leads.select(F.col("lead").alias("doc_id"), "key"), "doc_id"), "anchors"
    )
    kept = materialise(
        rows.join(wanted, "doc_id").filter(text_hash() == F.col("key")).select("doc_id", "text", "hs"), "candidates"
    )
    repeats = maximal_repeats(frames(kept)).filter("NOT first").select("kind", "h", "g", "doc_id", "start", "end")
    repeats = materialise(repeats, "repeats")
    later = repeats.filter("kind < 2").select("doc_id", "start", "end")
    windows = repeats.filter("kind = 2").select("h", "g", "doc_id", "start", "end")
    firsts = windows.groupBy("h", "g").agg(F.min(F.struct("doc_id", "start")).alias("lead"))
    hot = windows.join(firsts, ["h", "g"]).filter((F.col("doc_id") != F.col("lead.doc_id")) | (F.col("start") != F.col("lead.start")))
    hot = hot.select("doc_id", "start", "end")
    spans = later.unionByName(hot).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return every, kept.select("doc_id", "text").join(spans, "doc_id")


def _remaining(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """What stays, how many bytes go and in how many runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    begin, end = starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]
    kept, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist()):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), int((end - begin).sum()), len(begin)


def _cut(found: DataFrame, with_text: bool) -> DataFrame:
    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            limits = lists.offsets.to_numpy()
            flat = lists.flatten()
            starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            limits = limits - limits[0]
            out = []
            for k, text in enumerate(batch.column(1)):
                kept, removed, runs = _remaining(text.as_buffer().to_pybytes(), starts[limits[k] : limits[k + 1]], ends[limits[k] : limits[k + 1]])
                out.append((removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None))
            yield batch_of(
                cut_id=batch.column(0), removed=pa.array([o[0] for o in out], pa.int64()), runs=pa.array([o[1] for o in out], pa.int64()),
                kept=pa.array([o[2] for o in out], pa.string()), left_text=pa.array([o[3] for o in out], pa.string()),
            )

    return found.select("doc_id", "text", "spans").mapInArrow(work, "cut_id long, removed long, runs long, kept string, left_text string")


def digest(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per document.

    Every byte goes that a string of ``LENGTH`` bytes covers which also starts earlier: in a document with a
    smaller id, or before it in the same one. Strings are judged on the input and never cross documents. A
    null text counts as empty; shorter texts than ``LENGTH`` lose nothing. Rows without ``doc_id`` are left
    out; of several texts with one id the one of lowest hash counts, and repeated rows count once. Other
    columns are ignored; an empty table gives an empty result.
    """
    every, found = covered(docs, group_rows)
    cut = _cut(found, False)
    whole = F.col("copy") & (F.col("n_bytes") >= LENGTH)
    both = every.join(cut, every["doc_id"] == cut["cut_id"], "left")
    return both.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows of ``docs`` with an id, their repeated passages removed from the text.

    A character of which a byte went goes as a whole. A text that is a repeat as a whole becomes empty; its
    row stays. ``n_chars``, where there is such a column, follows a changed text. Rows that share an id all
    get the text left under it.
    """
    every, found = covered(docs, group_rows)
    cut = _cut(found, True)
    changed = every.join(cut, every["doc_id"] == cut["cut_id"], "left").select(
        F.col("doc_id").alias("__id"), F.when(F.col("copy") & (F.col("n_bytes") >= LENGTH), "").otherwise(F.col("left_text")).alias("__left")
    )
    rows = docs.join(changed, docs["doc_id"] == F.col("__id"))
    rows = rows.withColumn("text", F.coalesce("__left", "text"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("__left").isNotNull(), length).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
