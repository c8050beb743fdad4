"""Near duplicates by fast similarity sketching, banding and exact verification.

A text's set of word shingles becomes a sketch of ``t`` coordinates. In round ``i < t`` every shingle
falls into a hashed bin with a hashed value, and a bin keeps its lowest value of the earliest round;
rounds ``t + j`` put every shingle into bin ``j``. So every coordinate is filled whatever the set's
size, and the share of equal coordinates estimates the similarity with concentration as for ``t``
independent samples, at about the cost of one hash per shingle.

Texts of one set are one class, represented by its smallest id. Representatives that share a band
meet in a bucket. Each is first verified against one hub of the bucket; what is then in one component
needs no more comparisons. Texts with too few shingles in other components drop out, further hubs join
most of a large rest, and what pairs across components are left are verified in blocks. Verification counts the
common shingles of the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BASE, Spans, batch_of, lean, lowered, mixed, row_of, text_buffer, word_limits
from feedloom.llm.graph import components
from feedloom.session import materialise

WIDTH = 5
PERCENT = 85
#: 30 bands of 7 coordinates miss a pair at a similarity of 0.85 with a chance of 1e-5, at 0.9 of 3e-9.
BANDS = 30
ROWS = 7
#: Rounds of comparing with one hub per bucket before pairs across the components left are formed.
TURNS = 4
#: Texts of a cluster that are in memory together, twice.
BLOCK = 256
#: Such a round is worth its price while the pairs left are more than so many for each row in the buckets.
PAIRS_PER_ROW = 100
#: Bytes of text whose shingles are in memory at once; a longer text is taken alone.
CHUNK_BYTES = 1_000_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(data: np.ndarray, limits: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of every row, in order of row and hash."""
    data = lowered(data)
    starts, ends = word_limits(data, limits)
    words = Spans(data).hashes(starts, ends)
    rows = row_of(limits, starts)
    n = np.bincount(rows, minlength=len(limits) - 1)
    first = np.concatenate([[0], np.cumsum(n)])
    sizes = np.where(n >= width, width, n)
    count = np.where(n > 0, n - sizes + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    size = sizes[row]
    found = np.zeros(len(row), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        found = np.where(k < size, found * BASE + padded[at + k], found)
    found = mixed(found + size.astype(np.uint64))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[new], found[new]


def sketches(row: np.ndarray, found: np.ndarray, rows: int, size: int) -> np.ndarray:
    """The sketch of every row that has shingles; other rows keep the highest value everywhere.

    ``row`` and ``found`` are distinct shingles in order of row.
    """
    out = np.full((rows, size), ALL)
    open_rows = np.unique(row)
    local = np.searchsorted(open_rows, row)
    bins = np.full((len(open_rows), size), ALL)
    low = np.uint64((1 << 42) - 1)
    for i in range(2 * size):
        x = mixed(found ^ np.uint64((i + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
        at = (x >> np.uint64(40)) % np.uint64(size) if i < size else np.full(len(x), i - size, np.uint64)
        np.minimum.at(bins.reshape(-1), local * size + at.astype(np.int64), (np.uint64(i) << np.uint64(54)) | (x & low))
        full = ~(bins == ALL).any(axis=1)
        if full.any():
            out[open_rows[full]] = bins[full]
            keep = ~full
            if not keep.any():
                return out
            stays = keep[local]
            place = np.cumsum(keep) - 1
            open_rows, bins = open_rows[keep], bins[keep]
            local, found = place[local[stays]], found[stays]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(sketch), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sketch), b + 1, np.uint64)
        for k in range(rows):
            key = key * BASE + sketch[:, b * rows + k]
        keys[:, b] = mixed(key)
    return keys.view(np.int64)


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``CHUNK_BYTES`` of text: first row, end, bytes, limits."""
    data, limits = text_buffer(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(limits, limits[begin] + CHUNK_BYTES, side="right")) - 1)
        yield begin, end, data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin]
        begin = end


def _set_keys(row: np.ndarray, found: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each row's set and 128 bits that do not depend on the order."""
    n = np.bincount(row, minlength=rows)
    keys = []
    for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(found ^ salt))])
        ends = np.cumsum(n)
        keys.append((sums[ends] - sums[ends - n]).view(np.int64))
    return n, keys[0], keys[1]


def sketched(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, k1, k2, keys)``: set size, set hash and band keys of every row."""

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, limits in _chunks(batch, 1):
                row, found = shingles(data, limits, width)
                n, k1, k2 = _set_keys(row, found, end - begin)
                keys = band_keys(sketches(row, found, end - begin, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(end - begin + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
                yield batch_of(doc_id=batch.column(0).slice(begin, end - begin), n_shingles=pa.array(n, pa.int64()), k1=k1, k2=k2, keys=lists)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, n_shingles long, k1 long, k2 long, keys array<long>"
    )


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, k1, k2, shingles)``: the full set of every row."""

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, limits in _chunks(batch, 1):
                row, found = shingles(data, limits, width)
                n, k1, k2 = _set_keys(row, found, end - begin)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(found.view(np.int64))
                )
                yield batch_of(doc_id=batch.column(0).slice(begin, end - begin), k1=k1, k2=k2, shingles=lists)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, k1 long, k2 long, shingles array<long>"
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets have ``100 * common >= percent * all``."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        both.select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("sum"))
        .filter(100 * F.col("common") >= percent * (F.col("sum") - F.col("common")))
        .select("a", "b")
    )


def _alike_sizes(a: Column, b: Column, percent: int) -> Column:
    """No pair can reach the limit whose smaller set has less than this share of the larger one."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _able(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``rest`` whose set could still reach the limit with one of another component, with its
    number of shingles ``shared`` with other components.

    Common shingles of two components' texts occur in both; a text with too few shingles that any other
    component here holds is linked with none of them.
    """
    members = rest.select("id", "component", "n").distinct()
    each = members.join(sets, "id").select("id", "component", "n", F.explode("shingles").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("shingle")
    able = each.join(shared, "shingle").groupBy("id", "n").agg(F.count(F.lit(1)).alias("shared"))
    return rest.join(able.filter(100 * F.col("shared") >= percent * F.col("n")).select("id", "shared"), "id")


def _across(rest: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """The links ``(a, b)`` between components of texts that share buckets, directly or over others.

    Such texts form a cluster, cut into blocks of about ``block`` texts. Two blocks meet in one task, which
    counts the common shingles of all their pairs as a product of incidence matrices and returns the links.
    """
    lows = rest.groupBy("key").agg(F.min("id").alias("a"))
    shares = materialise(rest.join(lows, "key").select("a", F.col("id").alias("b")).distinct(), "shares")
    members = rest.select("id", "component").distinct().join(components(shares).withColumnRenamed("component", "cluster"), "id")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = members.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = members.select("cluster", "id", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "component").join(sets, "id")

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("id")
        ids, of = cell["id"].to_numpy(), cell["component"].to_numpy()
        sizes = cell["shingles"].map(len).to_numpy()
        row = np.repeat(np.arange(len(ids)), sizes)
        column = np.unique(np.concatenate(cell["shingles"].to_list()), return_inverse=True)[1]
        # shingles of one text alone are never common
        often = np.bincount(column) > 1
        place = np.cumsum(often) - 1
        row, column = row[often[column]], place[column[often[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(ids), len(ids)), np.float32)
        for begin in range(0, int(often.sum()), 4096):
            low, high = np.searchsorted(column, [begin, begin + 4096])
            held = np.zeros((len(ids), 4096), np.float32)
            held[row[low:high], column[low:high] - begin] = 1
            common += held @ held.T
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        a, b = np.nonzero(np.triu(linked & (of[:, None] != of[None, :]), 1))
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    return cells.groupBy("cluster", "i", "j").applyInPandas(links, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document.

    A document's set holds the distinct runs of ``width`` words, A-Z in lower case; with fewer words
    the whole sequence is the one shingle. Documents with equal sets are linked, and so are those with
    ``100 * common >= percent * all``; ``component_id`` is the smallest id reachable. A null or blank
    text has an empty set and is linked with nothing. Rows without ``doc_id`` are left out; of several
    rows with one id the set of lowest hash counts. Other columns are ignored, an empty table gives
    an empty result.
    """
    every = materialise(
        sketched(docs.filter("doc_id IS NOT NULL"), width, bands, rows)
        .groupBy("doc_id").agg(F.min(F.struct("k1", "k2", "n_shingles", "keys")).alias("x")).select("doc_id", "x.*"),
        "sketches",
    )
    classes = materialise(
        every.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n_shingles", "keys")).alias("x"))
        .select("k1", "k2", F.col("x.doc_id").alias("id"), F.col("x.n_shingles").alias("n"), "x.keys"),
        "classes",
    )
    banded = classes.select(F.explode("keys").alias("key"), "id", "n")
    order = F.struct(F.xxhash64("id").alias("h"), "id", "n")
    hubs = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(order).alias("hub")).filter("members > 1")
    buckets = materialise(
        banded.join(hubs, "key").select("key", "id", "n", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "buckets"
    )
    wanted = buckets.select("id").distinct().join(classes.select("id", "k1", "k2"), "id")
    texts = docs.select("doc_id", "text").join(wanted.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sets = materialise(
        shingle_sets(texts, width).join(wanted, ["k1", "k2"]).filter("doc_id = id").select("id", "shingles").dropDuplicates(["id"]), "sets"
    )
    star = (
        buckets.filter((F.col("id") != F.col("hub")) & _alike_sizes(F.col("n"), F.col("hub_n"), percent))
        .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    )
    links = materialise(verified(star, sets, percent), "links")
    whole = components(links)
    label = F.coalesce("component", "id").alias("component")
    for turn in range(TURNS):
        # buckets that still hold several components, without texts that cannot reach another one
        placed = buckets.select("key", "id", "n").join(whole, "id", "left").select("key", "id", "n", label)
        open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
        rest = materialise(placed.join(open_keys, "key", "left_semi"), "rest")
        rest = materialise(_able(rest, sets, percent), "rest")
        groups = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("key")
        groups = groups.agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
        held, pairs = groups.agg(F.sum("m"), F.sum((F.col("m") * F.col("m") - F.col("own")) / 2)).first()
        if not pairs or pairs <= PAIRS_PER_ROW * held or turn == TURNS - 1:
            break
        # the text with the fewest shingles of its own is nearest to what the bucket has in common
        lead = F.min(F.struct((F.col("n") - F.col("shared")) / F.col("n"), F.xxhash64("id", F.lit(turn)), "id", "n", "component"))
        hubs = rest.groupBy("key").agg(lead.alias("hub"))
        star = (
            rest.join(hubs, "key").filter((F.col("component") != F.col("hub.component")) & _alike_sizes(F.col("n"), F.col("hub.n"), percent))
            .select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
        )
        links = materialise(links.union(verified(star, sets, percent)), "links")
        whole = components(links)
    if pairs:
        whole = components(materialise(links.union(_across(rest, sets, percent)), "links"))
    named = classes.select("k1", "k2", "id").join(whole, "id", "left").select("k1", "k2", label.alias("component_id"))
    with_words = every.filter("n_shingles > 0").join(named, ["k1", "k2"])
    out = with_words.select("doc_id", "n_shingles", "component_id").unionByName(
        every.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
