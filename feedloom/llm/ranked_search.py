"""Ranked lexical search by pipelined term partitioning.

Documents are cut into shards of bounded size as their texts are read. A shard's postings, one row per term with
places, counts and lengths, are dealt to the owners of the terms: one owner for each range of weights, rarest
terms first. The items of a search travel in bundles. For every shard that shares a term with it, a bundle visits
one owner after another; a visit is a cogroup of the bundles and the owner's postings on (shard, bundle), which
adds the owner's integer contributions to the item's sparse accumulators, the scores of this shard's documents.
After the last owner the best of each shard meet and are ranked.

What the owners still ahead can add at most is known. An accumulator that cannot reach the ten best of its own
shard any more is left behind, and a document whose first term comes too late opens none. Both tests are exact:
such a document is beaten by ten others whatever follows.

Texts are filtered by a Bloom filter of the wanted terms, whose size is fixed; the join with the terms is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import Spans, batch_of, lean, lowered, row_of, text_buffer
from feedloom.session import materialise

#: Documents and bytes of text that a shard has at most (a longer text is a shard of its own).
SHARD_DOCUMENTS, SHARD_BYTES = 4_096, 6_000_000
#: Items that travel together.
BUNDLE = 64
#: Ranges of weights, each with an owner.
OWNERS = 4
#: Bits of the filter that texts are reduced by; 1 MB whatever the number of terms.
FILTER_BITS = 23
#: No quotient of a count and a length reaches this.
MOST = 1_000_000

LETTERS = np.zeros(256, bool)
LETTERS[128:] = True
for _first, _last in ("09", "AZ", "az"):
    LETTERS[ord(_first) : ord(_last) + 1] = True

POSTINGS = "shard long, term string, docs int, places binary, counts binary, lengths binary"
STATE = "shard long, bundle long, item_id long, reach long, places binary, scores binary"


def terms_of(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of all rows; a term never crosses a row limit."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = LETTERS[data]
    steps = np.diff(inside)
    first = np.zeros(len(data) + 1, bool)
    first[limits] = True
    both = first[1:-1] & (inside[1:-2] == 1) & (inside[2:-1] == 1)
    joints = np.flatnonzero(both) + 1
    starts = np.sort(np.concatenate([np.flatnonzero(steps == 1), joints]))
    ends = np.sort(np.concatenate([np.flatnonzero(steps == -1), joints]))
    return starts, ends


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each term once."""

    @lean
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffer(batch.column(1))
            data = lowered(data)
            starts, ends = terms_of(data, limits)
            whole = data.tobytes()
            words = [whole[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
            yield batch_of(item_id=batch.column(0).take(pa.array(row_of(limits, starts))), term=pa.array(words, pa.string()))

    texts = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(split, "item_id long, term string").distinct()


def bits_of(hashes: np.ndarray) -> list[np.ndarray]:
    return [(hashes >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1) for shift in (0, 24)]


def term_filter(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of the terms with two bits each; every task adds its own, and the driver gets their union."""

    @lean
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            data, limits = text_buffer(batch.column(0))
            hashes = Spans(data).hashes(limits[:-1], limits[1:])
            for bits in bits_of(hashes):
                found[bits.astype(np.int64)] = True
        words = np.packbits(found).view("<u8")
        filled = np.flatnonzero(words)
        yield batch_of(place=pa.array(filled, pa.int64()), word=pa.array(words[filled].view(np.int64)))

    parts = terms.select("term").mapInArrow(fill, "place long, word long")
    union = parts.groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros((1 << FILTER_BITS) // 64, "<u8")
    words[union["place"].to_numpy()] = union["word"].to_numpy().view(np.uint64)
    return words


def postings(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The shards' postings of the terms that ``wanted`` lets through.

    The row without a term has a shard's documents: their ids as ``places`` with a byte for each that is given,
    and their numbers of terms as ``lengths``. Places follow ascending ids, null last.
    """

    @lean
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = np.unpackbits(wanted.view(np.uint8)).astype(bool)
        shard = TaskContext.get().partitionId() << 36
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            run, cuts = 0, [0]
            for k, size in enumerate(sizes.tolist()):
                if k - cuts[-1] == SHARD_DOCUMENTS or (run + size > SHARD_BYTES and k > cuts[-1]):
                    cuts.append(k)
                    run = 0
                run += size
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if b > a:
                    yield _index_shard(batch.slice(a, b - a), shard, allowed)
                    shard += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(index, POSTINGS)


def _index_shard(batch: pa.RecordBatch, shard: int, allowed: np.ndarray) -> pa.RecordBatch:
    order = pc.sort_indices(batch.column(0))
    names, column = batch.column(0).take(order), batch.column(1).take(order)
    data, limits = text_buffer(column)
    data = lowered(data)
    starts, ends = terms_of(data, limits)
    rows = row_of(limits, starts)
    lengths = np.bincount(rows, minlength=len(names)).astype("<i8")
    hashes = Spans(data).hashes(starts, ends)
    low, high = (allowed[bits.astype(np.int64)] for bits in bits_of(hashes))
    kept = np.flatnonzero(low & high)
    hashes, rows, starts, ends = hashes[kept], rows[kept], starts[kept], ends[kept]
    by = np.lexsort((rows, hashes))
    hashes, rows, starts, ends = hashes[by], rows[by], starts[by], ends[by]
    fresh = np.ones(len(by), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(fresh)
    counts = np.diff(np.append(at, len(by))).astype("<i4")
    new_term = np.ones(len(at), bool)
    new_term[1:] = hashes[at][1:] != hashes[at][:-1]
    groups = np.append(np.flatnonzero(new_term), len(at)).tolist()
    places, their = rows[at].astype("<i4"), lengths[rows[at]]
    whole = data.tobytes()
    out: list[tuple] = [(None, len(names), names.fill_null(0).to_numpy().astype("<i8").tobytes(), names.is_valid().to_numpy(zero_copy_only=False).tobytes(), lengths.tobytes())]
    for a, b in zip(groups, groups[1:]):
        term = whole[int(starts[at[a]]) : int(ends[at[a]])].decode("utf-8")
        out.append((term, b - a, places[a:b].tobytes(), counts[a:b].tobytes(), their[a:b].tobytes()))
    terms, sizes, *parts = zip(*out)
    return batch_of(
        shard=pa.array([shard] * len(out), pa.int64()), term=pa.array(terms, pa.string()), docs=pa.array(sizes, pa.int32()),
        places=pa.array(parts[0], pa.binary()), counts=pa.array(parts[1], pa.binary()), lengths=pa.array(parts[2], pa.binary()),
    )


def weight(df: Column, n_docs: int) -> Column:
    return F.floor(F.lit(1000.0) * F.log((F.lit(2 * n_docs + 2)) / (2 * df + 1))).cast("long")


def visit(bundles: DataFrame, owned: DataFrame, items: DataFrame, owner: int, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """The bundles after one owner: ``owned`` has its postings, ``items`` the weights of the items' terms."""

    def add(state: pd.DataFrame, terms: pd.DataFrame) -> pd.DataFrame:
        out = []
        found = {}
        for row in terms.itertuples(index=False):
            lengths = np.frombuffer(row.lengths, "<i8")
            tf = np.frombuffer(row.counts, "<i4").astype(np.int64)
            m = 100 - 90 + (90 * lengths * n_docs) // n_terms
            found[row.term] = (np.frombuffer(row.places, "<i4"), (1_000_000_000 * tf) // (1000 * tf + 8 * m))
        for row in state.itertuples(index=False):
            places, scores = np.frombuffer(row.places, "<i4"), np.frombuffer(row.scores, "<i8")
            mine = [(found[t["term"]], t["w"]) for t in row.terms if t["owner"] == owner and t["term"] in found]
            here = sum(t["w"] for t in row.terms if t["owner"] == owner) * MOST
            ahead = sum(t["w"] for t in row.terms if t["owner"] > owner) * MOST
            if mine:
                all_places = np.concatenate([places, *[p for (p, _), _ in mine]])
                all_scores = np.concatenate([scores, *[w * q for (_, q), w in mine]])
                whole, back = np.unique(all_places, return_inverse=True)
                total = np.zeros(len(whole), np.int64)
                np.add.at(total, back, all_scores)
                if row.reach > here + ahead:  # ten here are beyond what a document without a score can still get
                    old = np.isin(whole, places, assume_unique=True)
                    whole, total = whole[old], total[old]
                places, scores = whole, total
            reach = row.reach
            if len(scores) >= best:
                reach = max(reach, int(np.partition(scores, -best)[-best]))
                chosen = scores + ahead >= reach
                places, scores = places[chosen], scores[chosen]
            out.append((row.shard, row.bundle, row.item_id, reach, places.astype("<i4").tobytes(), scores.astype("<i8").tobytes()))
        return pd.DataFrame(out, columns=["shard", "bundle", "item_id", "reach", "places", "scores"])

    loaded = bundles.join(items, ["bundle", "item_id"])
    return loaded.groupBy("shard", "bundle").cogroup(owned.groupBy("shard", "bundle")).applyInPandas(add, STATE)


def best_of_shards(bundles: DataFrame, best: int) -> DataFrame:
    """``(shard, item_id, place, score)``: the best of every shard, lower places (smaller ids) first among equals."""

    @lean
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, scores = [], [], []
            for k, (p, s) in enumerate(zip(batch.column(2), batch.column(3))):
                place, score = np.frombuffer(p.as_buffer(), "<i4"), np.frombuffer(s.as_buffer(), "<i8")
                chosen = np.lexsort((place, -score))[:best]
                chosen = chosen[score[chosen] > 0]
                rows.append(np.full(len(chosen), k))
                places.append(place[chosen])
                scores.append(score[chosen])
            if rows:
                at = pa.array(np.concatenate(rows))
                yield batch_of(
                    shard=batch.column(0).take(at), item_id=batch.column(1).take(at),
                    place=pa.array(np.concatenate(places).astype(np.int32)), score=pa.array(np.concatenate(scores).astype(np.int64)),
                )

    return bundles.select("shard", "item_id", "places", "scores").mapInArrow(choose, "shard long, item_id long, place int, score long")


def names_of(documents: DataFrame) -> DataFrame:
    """``(shard, place, doc_id)`` from the shards' rows without a term."""

    @lean
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, ids, given in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                names = np.frombuffer(ids.as_buffer(), "<i8").astype(np.int64)
                missing = np.frombuffer(given.as_buffer(), np.uint8) == 0
                yield batch_of(
                    shard=pa.array(np.full(len(names), shard)), place=pa.array(np.arange(len(names), dtype=np.int32)),
                    doc_id=pa.array(names, pa.int64(), mask=missing),
                )

    return documents.select("shard", "places", "counts").mapInArrow(unfold, "shard long, place int, doc_id long")


def search(docs: DataFrame, items: DataFrame, best: int = 10, owners: int = OWNERS, bundle: int = BUNDLE) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``best`` documents of every item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns are ignored. Null,
    empty and blank texts have no terms: such documents count in nothing and are never found, such items find
    nothing. Equal scores go by ascending ``doc_id``, documents without one last. Repeated documents are
    documents of their own, with a rank each; rows of an item that stands more than once have their terms
    together. Items without an id are ignored. Either table empty gives an empty result.
    """
    spark = docs.sparkSession
    asked = materialise(item_terms(items.filter("item_id IS NOT NULL")), "item-terms")
    index = materialise(postings(docs, term_filter(asked)), "postings")
    shards, entries = index.filter("term IS NULL"), index.filter("term IS NOT NULL")

    @lean
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            for x in batch.column(0):
                lengths = np.frombuffer(x.as_buffer(), "<i8")
                n += int((lengths > 0).sum())
                total += int(lengths.sum())
        yield batch_of(n=pa.array([n], pa.int64()), total=pa.array([total], pa.int64()))

    n_docs, n_terms = shards.select("lengths").mapInArrow(totals, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weights = entries.groupBy("term").agg(F.sum("docs").alias("df")).select("term", weight(F.col("df"), n_docs).alias("w"))
    step = (weight(F.lit(0), n_docs) / owners).cast("double")
    weighted = asked.join(weights, "term").select(
        "item_id", "term", "w", F.greatest(F.lit(0), F.lit(owners - 1) - F.floor(F.col("w") / step)).cast("int").alias("owner"),
        F.pmod(F.xxhash64("item_id"), F.greatest(F.lit(1), F.ceil(F.lit(asked.agg(F.count_distinct("item_id")).first()[0]) / bundle))).alias("bundle"),
    )
    weighted = materialise(weighted, "item-weights")
    terms = F.collect_list(F.struct("term", "w", "owner")).alias("terms")
    bundled = materialise(weighted.groupBy("bundle", "item_id").agg(terms), "bundles")
    # the postings that a bundle meets at each owner
    owned = entries.join(weighted.select("term", "owner", "bundle").distinct(), "term").drop("docs")
    owned = materialise(owned, "owned")
    empty = F.lit(b"")
    begun = owned.select("shard", "bundle").distinct().join(bundled.select("bundle", "item_id"), "bundle")
    state = begun.select("shard", "bundle", "item_id", F.lit(0).cast("long").alias("reach"), empty.alias("places"), empty.alias("scores"))
    state = materialise(state, "accumulators")
    for owner in range(owners):
        state = materialise(visit(state, owned.filter(F.col("owner") == owner), bundled, owner, n_docs, n_terms, best), "accumulators")
    found = best_of_shards(state, best).join(names_of(shards), ["shard", "place"])
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")


#: The same ranking in plain SQL.
ORACLE = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark),
scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
