"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a bounded sample (principal axes of the directions, then the rotation that brings the
projections closest to their signs) turns every vector's direction into a binary code. A code is split into
substrings and each is indexed. Two codes within a Hamming radius agree within ``radius // parts`` bits in at
least one substring, so probing all substring values that near finds every code within the radius; these are
reranked by the inner product of the original vectors.

Codes know directions only, and an inner product grows with the length too, so rows are indexed by bands of
length, each a factor of two. The radius is chosen per query and band: a bounded sample of the band shows how
far the codes of its best rows lie from the query's code, and the furthest of them sets the radius. A nearest
row is one more draw of such rows, so it lies beyond the furthest of ``m`` with a chance of ``1 / (m + 1)`` at
most, whatever the vectors' offset, lengths or dimension; it is smaller where nearer rows have nearer codes.
Bands too short for any of their rows to reach the sampled scores are passed over, which loses nothing. All
rows are indexed, in blocks; queries meet every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialise

#: Rows that the rotation and the radius are fitted on, at most about this many or ``BAND_ROWS`` a band.
SAMPLE_ROWS = 4_096
BITS = 64
#: Bands of length; rows shorter than all of them belong to the last one.
BANDS = 12
#: Rows of a band's sample, at least, for each row that sets the radius.
BAND_ROWS = 8
#: Rows of the sample that set the radius, for each neighbour wanted.
REACH = 2
BLOCK_ROWS = 8_192
QUERY_ROWS = 2_048


def directions(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length 1; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@dataclass
class Codes:
    """Mean and projection of directions to signed bits, and the sample that sets each query's radius."""

    mean: np.ndarray
    projection: np.ndarray
    sample: np.ndarray
    bands: np.ndarray

    def __post_init__(self):
        self.codes = self.encode(self.sample)

    @property
    def bits(self) -> int:
        return self.projection.shape[1]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Substring values, one column for each part of 16 bits."""
        signs = ((directions(vectors) - self.mean) @ self.projection > 0).astype(np.uint16)
        padded = np.zeros((len(signs), -(-self.bits // 16) * 16), np.uint16)
        padded[:, : self.bits] = signs
        weights = (1 << np.arange(16)).astype(np.uint16)
        return (padded.reshape(len(signs), -1, 16) * weights).sum(axis=2).astype(np.uint16)

    def reach(self, query: np.ndarray, code: np.ndarray, k: int, rows: int) -> tuple[float, dict[int, int]]:
        """A score that the ``k`` nearest have at least, and the radius of each band of the sample.

        The query itself may be in the sample, so one row more is counted. Equal scores count together, as the
        smaller id decides between them.
        """
        scores = self.sample @ query

        def at_place(values: np.ndarray, place: int) -> float:
            return -np.partition(-values, place - 1)[place - 1] if len(values) >= place else -np.inf

        radii = {}
        for band in np.unique(self.bands):
            here = np.flatnonzero(self.bands == band)
            least = at_place(scores[here], rows)
            best = here[scores[here] >= least - 1e-9 * abs(least)] if np.isfinite(least) else here
            radii[int(band)] = int(np.bitwise_count(self.codes[best] ^ code).sum(axis=1).max())
        return at_place(scores, k + 1), radii


def fit_codes(sample: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 9, bands: np.ndarray | None = None) -> Codes:
    """Iterative quantization: alternate between the signs and the rotation nearest to them."""
    unit = directions(sample)
    mean = unit.mean(axis=0)
    centred = unit - mean
    bits = min(bits, sample.shape[1])
    axes = np.linalg.svd(centred, full_matrices=len(centred) < centred.shape[1])[2][:bits].T
    projected = centred @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
        rotation = right.T @ left.T
    return Codes(mean, axes @ rotation, sample, np.zeros(len(sample), int) if bands is None else bands)


class MultiIndex:
    """The codes of one block: rows by value of each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for part in range(codes.shape[1]):
            order = np.argsort(codes[:, part], kind="stable")
            values, first = np.unique(codes[order, part], return_index=True)
            self.tables.append((values, np.append(first, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within ``radius``: probe each substring, then the whole code."""
        parts = len(self.tables)
        hit = np.zeros(len(self.codes), bool)
        for part, (values, first, order) in enumerate(self.tables):
            # radii of the substrings add up to radius - parts + 1, which the pigeonhole needs
            near = (radius - parts + 1 + part) // parts if radius >= parts - 1 else (0 if part >= parts - 1 - radius else -1)
            close = np.bitwise_count(values ^ code[part]) <= near
            found = np.flatnonzero(close)
            if len(found) > 16:
                hit[order[np.repeat(close, np.diff(first))]] = True
            else:
                for v in found:
                    hit[order[first[v] : first[v + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part, in double precision."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine
    )


def with_length_band(vectors: DataFrame) -> DataFrame:
    """Add ``band``, the power of two at or below the vector's length, by logarithms, so that no square overflows."""
    # the largest component is a column of its own: it would be found again for each component otherwise
    most = vectors.withColumn("most", F.array_max(F.transform("v", F.abs)))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x / F.col("most")) * (x / F.col("most")))
    return most.withColumn("band", F.floor(F.log2("most") + F.log2(squares) / 2).cast("int")).drop("most")


def nearest(
    vectors: DataFrame,
    queries: Column | None = None,
    k: int = 20,
    id_column: str = "vec_id",
    column: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    bits: int = BITS,
    reach: int = REACH,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product with each query.

    ``queries`` is a condition on ``vec_id``; candidates are all rows but the query's own. In each band of
    length, ``reach * (k + 1)`` rows of its sample set the radius. Where no band of a block holds ``k``
    candidates within it, it grows until they hold so many or the whole block.
    Vectors that are null, zero, of another length than most, or hold a null or non-finite component
    take no part, nor do rows without id; of rows that repeat an id one counts. Of equal vectors only
    the ``k + 1`` smallest ids can be among the nearest, so only they are indexed; that loses nothing.
    Ties go to the smaller id. Other columns are ignored; an empty table gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = materialise(usable(vectors, id_column, column).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == sizes["n"])
    ranked = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = rows.withColumn("copy", ranked).filter(F.col("copy") <= k + 1)
    distinct = materialise(with_length_band(distinct), "index")
    longest, total = distinct.agg(F.max("band"), F.count(F.lit(1))).first()
    distinct = distinct.withColumn("band", F.greatest("band", F.lit(longest - BANDS + 1)))
    single = F.col("copy") == 1
    counted = distinct.filter(single).groupBy("band").count().toArrow().to_pydict()
    setting = reach * (k + 1)
    wanted_rows = max(sample_rows // len(counted["band"]), BAND_ROWS * setting)
    share = F.create_map(*[F.lit(x) for b, n in zip(counted["band"], counted["count"]) for x in (b, min(1.0, wanted_rows / n))])
    draw = F.xxhash64("vec_id", F.lit(9)).bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(float(1 << 32))
    drawn = distinct.filter(single & (draw <= share[F.col("band")])).select("vec_id", "v", "band").toArrow().sort_by("vec_id")
    if not len(drawn):
        drawn = distinct.orderBy("vec_id").limit(1).select("vec_id", "v", "band").toArrow()
    codes = fit_codes(np.array(drawn.column("v").to_pylist()), bits, bands=np.array(drawn.column("band").to_pylist()))

    asked = rows if queries is None else rows.filter(queries)
    blocks = max(1, -(-total // block_rows))
    parts = max(1, -(-asked.count() // query_rows))
    # each block of the index meets each part of the queries in one cell; both sides need keys of one type, as
    # an int and a long of equal value are dealt to different tasks
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    part = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(parts)).cast("int").alias("part")
    indexed = distinct.select("vec_id", "v", "band", block, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asked = asked.select("vec_id", "v", part, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
        if not len(left) or not len(right):
            return pd.DataFrame(none)
        left = left.sort_values(["band", "vec_id"])
        ids, bands, matrix = left["vec_id"].to_numpy(), left["band"].to_numpy(), np.array(left["v"].tolist())
        own = codes.encode(matrix)
        indexes = []
        for band in np.unique(bands):
            first, last = np.searchsorted(bands, [band, band + 1])
            indexes.append((int(band), int(first), MultiIndex(own[first:last])))
        names, wanted = right["vec_id"].to_numpy(), np.array(right["v"].tolist())
        found = []
        for name, vector, code in zip(names, wanted, codes.encode(wanted)):
            least, radii = codes.reach(vector, code, k, setting)
            length = np.abs(vector).max() * np.linalg.norm(vector / np.abs(vector).max())
            # a row of the band is shorter than twice its power of two
            open_ = [x for x in indexes if length * 2.0 ** min(x[0] + 1, 1023) * (1 + 1e-9) >= least]
            more = 0
            while True:
                near = [first + index.within(code, radii.get(band, codes.bits) + more) for band, first, index in open_]
                near = np.concatenate([*near, np.zeros(0, np.int64)]).astype(np.int64)
                near = near[ids[near] != name]
                if len(near) >= k or more >= codes.bits or not open_:
                    break
                more += 1
            scores = matrix[near] @ vector
            if len(near) > k:
                kth = -np.partition(-scores, k - 1)[k - 1]
                keep = scores >= kth
                near, scores = near[keep], scores[keep]
            order = np.lexsort((ids[near], -scores))[:k]
            found.append((np.full(len(order), name), ids[near[order]], scores[order]))
        return pd.DataFrame({c: np.concatenate([f[j] for f in found]) for j, c in enumerate(none)})

    pairs = indexed.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
