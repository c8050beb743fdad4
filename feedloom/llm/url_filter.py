"""URL verdicts: listed rules first, gradient-boosted trees on lexical features for the rest.

Parsing and rules are column expressions. The trees are fitted on a bounded sample of labelled URLs,
here those that a rule covers; statistics by suffix come from all labelled rows. Every URL is then
scored in Arrow batches with the fitted trees.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import batch_of, row_of, text_buffer
from feedloom.session import materialise

#: (rule text as host and path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Different labelled URLs that are drawn for the trees, at most about this many; beside them come those with
#: as large a share of the rows as one in this many.
SAMPLE_ROWS = 50_000
#: Suffixes with statistics of their own; all rarer ones share the overall rate.
SUFFIXES = 4_096
BINS = 32
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio", "upper_ratio",
    "entropy", "parameters", "hyphens", "escapes", "suffix_share", "suffix_rate",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, ties to the first in order of text; else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _counts(flags: np.ndarray, limits: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[limits[1:]] - sums[limits[:-1]]).astype(np.float64)


def lexical_features(urls: pa.Array, hosts: pa.Array, paths: pa.Array, suffixes: dict[str, tuple[float, float]]) -> np.ndarray:
    """One row of ``FEATURES`` for each URL, from byte counts over the whole batch."""
    data, limits = text_buffer(urls)
    rows = len(limits) - 1
    n = np.diff(limits).astype(np.float64)
    size = np.maximum(n, 1)
    row = row_of(limits, np.arange(len(data)))
    cells = np.bincount(row * 256 + data, minlength=rows * 256).reshape(rows, 256) / size[:, None]
    entropy = -(cells * np.log2(np.maximum(cells, 1e-12))).sum(axis=1)
    is_ = lambda c: data == ord(c)
    digits = _counts((data >= 48) & (data <= 57), limits)
    uppers = _counts((data >= 65) & (data <= 90), limits)
    host_data, host_limits = text_buffer(hosts)
    path_data, path_limits = text_buffer(paths)
    names = [h or "" for h in hosts.to_pylist()]
    ends = [suffixes.get(h.rpartition(".")[2], suffixes[""]) for h in names]
    return np.column_stack([
        n,
        np.diff(host_limits),
        np.diff(path_limits),
        _counts(path_data == ord("/"), path_limits),
        _counts(host_data == ord("."), host_limits),
        [max(map(len, h.split("."))) for h in names],
        digits / size,
        uppers / size,
        entropy,
        _counts(is_("&"), limits) + _counts(is_("?"), limits),
        _counts(is_("-"), limits),
        _counts(is_("%"), limits),
        [e[0] for e in ends],
        [e[1] for e in ends],
    ]).astype(np.float64)


@dataclass
class Trees:
    """Boosted trees of a fixed depth as arrays: feature and bin limit of each node, value of each leaf."""

    edges: list[np.ndarray]
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray
    base: float
    depth: int

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        total = np.full(len(x), self.base)
        at = np.arange(len(x))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[at, features[node]] > limits[node])
            total += leaves[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, penalty: float = 1.0, least: float = 5.0,
    weights: np.ndarray | None = None,
) -> Trees:
    """Logistic boosting with second-order gains over binned features; each row counts by its weight, 1 if not given."""
    weights = np.ones(len(x)) if weights is None else weights
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    mean = np.clip(np.average(y, weights=weights), 1e-3, 1 - 1e-3)
    model = Trees(edges, np.zeros((trees, 2**depth - 1), int), np.full((trees, 2**depth - 1), BINS), np.zeros((trees, 2**depth)), float(np.log(mean / (1 - mean))), depth)
    bins = model.binned(x)
    total = np.full(len(x), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = weights * (p - y), weights * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for f in range(x.shape[1]):
                cell = (node - first) * BINS + bins[:, f]
                left_g = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                left_h = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + penalty) + (all_g - left_g) ** 2 / (all_h - left_h + penalty) - all_g**2 / (all_h + penalty)
                gain[(left_h < least) | (all_h - left_h < least)] = 0
                where = gain.argmax(axis=1)
                value = gain[np.arange(width), where]
                better = value > best
                best[better] = value[better]
                model.features[t, first : first + width][better] = f
                model.limits[t, first : first + width][better] = where[better]
            node = 2 * node + 1 + (bins[np.arange(len(x)), model.features[t, node]] > model.limits[t, node])
        leaf = node - (2**depth - 1)
        sums_g, sums_h = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        model.leaves[t] = -rate * sums_g / (sums_h + penalty)
        total += model.leaves[t, leaf]
    return model


def suffix_statistics(labelled: DataFrame, most: int = SUFFIXES) -> dict[str, tuple[float, float]]:
    """Share of the labelled rows and smoothed rate of blocked ones for the ``most`` frequent suffixes.

    Under the empty key stands what all other suffixes get.
    """
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("b")).first()
    rate = (total["b"] or 0) / total["n"] if total["n"] else 0.5
    rows = (
        labelled.groupBy(suffix_of(F.col("host")).alias("suffix"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("b"))
        .orderBy(F.desc("n"), "suffix")
        .limit(most)
        .collect()
    )
    found = {r["suffix"]: (r["n"] / total["n"], (r["b"] + 10 * rate) / (r["n"] + 10)) for r in rows}
    return {**found, "": (0.0, rate)}


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Trees | None, dict[str, tuple[float, float]]]:
    """Trees and suffix statistics from ``(url, host, path, label)`` with label 1 for block.

    Copies of a URL are one row with their number as weight. The trees see all URLs up to ``sample_rows``;
    beyond that, the share of them with the lowest hashes that yields about so many, and with the weight of
    that share every URL that has a ``sample_rows``-th of all rows or more. Without both labels there are no
    trees.
    """
    suffixes = suffix_statistics(labelled)
    urls = materialise(labelled.groupBy("url", "host", "path", "label").agg(F.count(F.lit(1)).alias("n")), "urls")
    distinct, total = urls.agg(F.count(F.lit(1)), F.sum("n")).first()
    share = min(1.0, sample_rows / max(distinct, 1))
    heavy = F.col("n") * sample_rows >= (total or 0)
    drawn = (F.xxhash64("url", F.lit(5)).bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(float(1 << 32))) <= share
    weight = F.when(heavy, F.col("n") * share).otherwise(F.col("n")).cast("double").alias("weight")
    sample = urls.filter(heavy | drawn).select("url", "host", "path", "label", weight).toArrow().sort_by([("url", "ascending"), ("label", "ascending")])
    y = np.array(sample.column("label").to_pylist(), np.float64)
    if len(np.unique(y)) < 2:
        return None, suffixes
    column = lambda c: sample.column(c).combine_chunks()
    x = lexical_features(column("url"), column("host"), column("path"), suffixes)
    return fit_trees(x, y, weights=sample.column("weight").to_numpy()), suffixes


def verdicts(pages: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS, least: float = 0.5) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``; score is the trees' probability of block.

    A null URL or one without ``://`` has an empty host and path; like any URL without a rule it gets
    the trees' verdict. Where no labelled URL is at hand to fit on, or all have one label, the score
    is the share of blocked labels (0 without any label). Repeated rows are judged each, a null
    ``page_id`` stays null, other columns are ignored, an empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id"), F.coalesce(url, F.lit("")).alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.filter(F.col("found").isNotNull()).select(
        "url", "host", "path", (F.col("found.verdict") == "block").cast("int").alias("label")
    )
    model, suffixes = fit(labelled, sample_rows)
    rows = rows.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("listed"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None:
                p = np.full(b.num_rows, suffixes[""][1] if suffixes.keys() - {""} else 0.0)
            else:
                p = model.probability(lexical_features(b.column("url"), b.column("host"), b.column("path"), suffixes)) if b.num_rows else np.zeros(0)
            yield batch_of(page_id=b.column("page_id"), host=b.column("host"), path=b.column("path"), rule=b.column("rule"), listed=b.column("listed"), score=p)

    kind = pages.schema["page_id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"page_id {kind}, host string, path string, rule string, listed string, score double")
    own = F.when(F.col("score") >= least, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("listed", own).alias("verdict"), "score")
