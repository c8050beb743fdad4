"""XML feeds: fragments between ``<job>`` and ``</job>`` in plain or gzip text files.

The text is split on the start tag by the file source itself, so one big plain file is read by many
tasks and a damaged fragment only costs itself. Splitting on the end tag would keep a truncated tail.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import repair_xml, strip, unescape_web_address
from feedloom.operators.ordinals import with_ordinal
from feedloom.sources.batches import slices

START, END = "<job>", "</job>"
_CORRUPT = "_corrupt_record"


def _fragments(lines: DataFrame, cut: str, attributes: bool, *place: Column) -> DataFrame:
    """Complete fragments, repaired, with the path and size of their file, ``place`` and their number in the record.

    A record of the file source lies between two cuts. It is divided again before every start tag, so that what
    stands before the first cut of a file, or behind another kind of start tag, is never taken for a posting.
    """
    part = F.posexplode(F.split(F.concat(F.lit(cut), F.col("value")), r"(?=<job[\s>])")).alias("part", "text")
    parts = lines.filter(F.contains("value", F.lit(END))).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
        *place, part,
    )
    begins = F.col("text").rlike(r"^<job[\s>]") if attributes else F.col("text").startswith(START)
    return parts.filter(begins & F.contains("text", F.lit(END))).select(
        repair_xml(F.concat(F.substring_index("text", END, 1), F.lit(END))).alias("fragment"),
        *[c for c in parts.columns if c != "text"],
    )


def scan_fragments(spark: SparkSession, path: str | Sequence[str], attributes: bool = False, cut: str | None = None) -> DataFrame:
    """One row per complete fragment of the feed files below ``path``.

    ``attributes=True`` also accepts start tags with attributes; by default only the bare tag counts. ``cut`` is
    where the file source splits a file into records, by default the start tag of the kind asked for; postings of
    both kinds come in feed order whatever it is, but a file is held by pieces no shorter than it divides it.
    ``position`` orders the rows as they stand in the files. It is taken in the scanning task, from
    the split and the row number in it, and so stays the same when a task is run again.
    """
    cut = cut or ("<job " if attributes else START)
    place = F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("row")
    fragments = _fragments(spark.read.option("lineSep", cut).text(path), cut, attributes, *place)
    position = F.struct("file_path", "block_start", "row", "part")
    return fragments.withColumn("position", position).drop("block_start", "row", "part")


def stream_fragments(spark: SparkSession, path: str) -> DataFrame:
    """The streaming form of ``scan_fragments``: each new file below ``path`` is read once."""
    found = _fragments(spark.readStream.option("lineSep", START).format("text").load(path), START, False)
    return found.drop("part")


def accepted(fragments: DataFrame) -> DataFrame:
    """The fragments that are XML, which are those that :func:`parse_fragments` keeps."""
    options = {"rowTag": "job", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "ignoreNamespace": "true"}
    parsed = fragments.select("*", F.explode(F.array(F.from_xml("fragment", f"{_CORRUPT} string", options))).alias("_job"))
    return parsed.filter(F.col("_job").isNotNull() & F.col(f"_job.{_CORRUPT}").isNull()).drop("_job")


def tag_schema(tags: Sequence[str], attributes: bool = False) -> T.StructType:
    """Strings for all tags; a nested element arrives as its text. ``attributes`` adds ``_name`` fields."""
    lowered = list(dict.fromkeys(t.lower() for t in tags))
    names = lowered + ([f"_{t}" for t in lowered] if attributes else [])
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])


def parse_fragments(fragments: DataFrame, tags: Sequence[str], attributes: bool = False) -> DataFrame:
    """Fragments as a struct ``job`` of the wanted tags; fragments that are no XML are dropped."""
    options = {
        "rowTag": "job", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "ignoreNamespace": "true",
    }
    schema = tag_schema(tags, attributes)
    # behind a generator, so that filters on the result are not pushed down as further parses
    parsed = fragments.select("*", F.explode(F.array(F.from_xml("fragment", schema.simpleString(), options))).alias("job"))
    return parsed.filter(F.col("job").isNotNull() & F.col(f"job.{_CORRUPT}").isNull())


def mapped_fields(
    mappings: Mapping[str, str], value_of: Callable[[str], Column]
) -> list[Column]:
    """One column per target; of several sources the last filled one in mapping order wins."""
    sources: dict[str, list[str]] = {}
    for source, target in mappings.items():
        sources.setdefault(target, []).append(source)
    return [
        F.coalesce(*[value_of(s) for s in reversed(names)]).alias(target) for target, names in sources.items()
    ]


def read_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    mappings: Mapping[str, str],
    attributes: bool = False,
    extract: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Scan, parse and map a feed: one row per posting, one column per mapped target.

    ``extract`` replaces the default extractor, a function from source tag to column.
    """
    parsed = parse_fragments(scan_fragments(spark, path, attributes), list(mappings), attributes)
    return mapped_postings(parsed, mappings, attributes, extract)


def mapped_postings(
    parsed: DataFrame,
    mappings: Mapping[str, str],
    attributes: bool = False,
    extract: Callable[[str], Column] | None = None,
) -> DataFrame:
    def raw_value(tag: str) -> Column:
        candidates = [F.nullif(strip(F.col("job")[tag.lower()]), F.lit(""))]
        if attributes:
            candidates.append(F.nullif(F.col("job")[f"_{tag.lower()}"], F.lit("")))
        return F.coalesce(*candidates)

    targets = list(dict.fromkeys(mappings.values()))
    kept = [c for c in ("position", "file_path", "file_size") if c in parsed.columns]
    rows = parsed.select(*mapped_fields(mappings, extract or raw_value), *kept)
    rows = rows.filter(F.coalesce(*[F.col(t) for t in targets]).isNotNull()) if targets else rows
    if extract is not None:
        return rows
    return rows.select(*[unescape_web_address(F.col(t)).alias(t) for t in targets], *kept)


def numbered(rows: DataFrame, name: str = "seq") -> DataFrame:
    """Unique integers from 1 in feed order, as a run needs them.

    Rows are numbered inside each split of a file and offset by the earlier splits. ``rows`` is read
    twice; pass a written table when parsing is costly.
    """
    split = F.struct("position.file_path", "position.block_start")
    return with_ordinal(rows, [], "position", name, range_of=split)


_PREFIX = r"(</?|\s)[\w.-]+:(?=[\w.-]+[\s=/>])"


def _elements(fragment: str) -> list[tuple[str, str]]:
    """``(tag, value)`` of a fragment: attributes of the job as ``_name``, then all elements by their path."""
    try:
        job = ElementTree.fromstring(fragment)
    except ElementTree.ParseError:
        try:  # prefixes of a namespace that is declared outside
            job = ElementTree.fromstring(re.sub(_PREFIX, r"\1", fragment))
        except ElementTree.ParseError:
            return []
    out = [(f"_{name.rpartition('}')[2]}", value) for name, value in job.attrib.items()]

    def go(parent: ElementTree.Element, path: str) -> None:
        for child in parent:
            name = path + str(child.tag).rpartition("}")[2]
            out.append((name, child.text or ""))
            go(child, name + "/")

    go(job, "")
    return out


def raw_tags(fragments: DataFrame) -> DataFrame:
    """``(file_path, [position,] pos, tag, value)``: everything in the accepted fragments, for feeds of unknown tags.

    An element has its own text, trimmed; one inside another has the path as its tag; repeated ones are a row
    each; an empty one has an empty value. Attributes of the job come first, ``_`` before their name. The tree of
    unknown depth is taken apart in Arrow batches, a bounded piece of one at a time.
    """
    kept = [c for c in ("file_path", "position") if c in fragments.columns]
    rows = accepted(fragments).select("fragment", *kept)
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("pos", T.IntegerType()), T.StructField("tag", T.StringType()), T.StructField("value", T.StringType())])

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in slices(whole, 0)):
            found = [_elements(fragment) for fragment in batch.column(0).to_pylist()]
            at = pa.array([k for k, tags in enumerate(found) for _ in tags], pa.int64())
            columns = [
                *[batch.column(1 + k).take(at) for k in range(len(kept))],
                pa.array([pos for tags in found for pos in range(len(tags))], pa.int32()),
                pa.array([tag for tags in found for tag, _ in tags], pa.string()),
                pa.array([value for tags in found for _, value in tags], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "pos", "tag", "value"])

    return rows.mapInArrow(take_apart, schema).withColumn("value", unescape_web_address(strip(F.col("value"))))


def feed_sizes(fragments: DataFrame) -> DataFrame:
    """Bytes and accepted fragments per feed file."""
    return accepted(fragments).groupBy("file_path").agg(
        F.max("file_size").alias("feed_file_size_bytes"), F.count(F.lit(1)).alias("total_in_feed")
    )
