"""Quality rules: word statistics of each text, and lines that too many documents of a host share.

Only DataFrame functions are used. One scan turns each text into counts and an array of line hashes;
everything after it works on those narrow rows. A line is frequent on its host when ``min_docs`` or more
different documents of the host hold it, however many documents the host has: boilerplate is judged alike on
small and large hosts, and no line becomes allowed again as a host grows. Documents with the same text are one
document here; told apart by their ids, ten copies of any document would make all its lines frequent and the
whole group depleted, so that none would be left for the removal of copies. Counting is a distinct aggregate
with partial sums, so a host or a line may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BLANKS
from feedloom.session import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Documents of a host that hold a frequent line, at least.
MIN_DOCS = 10
#: A document is depleted when less than this percentage of its words is left.
LEFT_PERCENT = 30


def words_of(text: Column) -> Column:
    inner = F.regexp_replace(text, f"^{BLANKS}|{BLANKS}$", "")
    return F.when(inner != "", F.split(inner, BLANKS)).otherwise(F.array().cast("array<string>"))


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), BLANKS, " "))


def line_key(line: Column) -> Column:
    """96 bits of hash of a normalised line."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("h"), F.hash(text).alias("g"))


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """``(doc_id, host, key, counts, lines)``, one row per different document and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.struct(text_key(text).alias("hashes"), F.col("text").isNull().alias("missing")).alias("key"),
        text.alias("text"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")),
    )
    counted = rows.select(
        "doc_id",
        "host",
        "key",
        "n_words",
        F.length(F.regexp_replace("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", f"[{SYMBOLS}]")) - 1).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("windows"),
        F.transform(
            F.transform("lines", normal_line),
            lambda x: F.struct(line_key(x).alias("line"), F.size(F.split(x, " ")).alias("words")),
        ).alias("lines"),
    )
    repeated = F.filter(
        "windows",
        lambda w, i: F.coalesce(w["h"] == F.get("windows", i - 1)["h"], F.lit(False))
        | F.coalesce(w["h"] == F.get("windows", i + 1)["h"], F.lit(False)),
    )
    places = F.flatten(F.transform(repeated, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    out = counted.withColumn("n_repeat_words", F.size(F.array_distinct(places)).cast("long")).drop("windows")
    return out.dropDuplicates(["doc_id", "host", "key"])


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(host, line)`` of the lines that at least ``min_docs`` different documents of their host hold."""
    lines = rows.select("host", "key", F.explode(F.array_distinct("lines.line")).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("key").alias("docs"))
    return counts.filter(F.col("docs") >= min_docs).select("host", "line")


def judged(
    docs: DataFrame,
    host: str = "source",
    min_docs: int = MIN_DOCS,
    left_percent: int = LEFT_PERCENT,
) -> DataFrame:
    """Counts and verdict of every document, and the lines to remove from it.

    ``(doc_id, host, key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    words_left, frequent, kept)``; ``frequent`` holds the keys of the document's frequent lines. A null
    text has no words and fails; a null host is a host of its own, the empty one; a null ``doc_id``
    stays null and is judged as any other. Rows that repeat id, host and text count once. Columns
    beside the id, the text and the host are ignored. An empty table gives an empty result.
    """
    rows = materialise(measured(docs, host), "measured")
    lines = rows.select("doc_id", "host", "key", F.explode("lines").alias("x")).select("doc_id", "host", "key", "x.*")
    frequent = materialise(frequent_lines(rows, min_docs), "frequent")
    removed = (
        lines.join(frequent, ["host", "line"])
        .groupBy(F.col("doc_id").alias("r_id"), F.col("host").alias("r_host"), F.col("key").alias("r_key"))
        .agg(F.sum("words").alias("removed"), F.collect_set("line").alias("frequent"))
    )
    both = rows.drop("lines").join(
        removed,
        F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("host") == F.col("r_host")) & (F.col("key") == F.col("r_key")),
        "left",
    )
    n = F.col("n_words")
    left = n - F.coalesce(F.col("removed"), F.lit(0))
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return both.select(
        "doc_id", "host", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        left.alias("words_left"),
        "frequent",
        (~failed & (100 * left >= left_percent * n)).alias("kept"),
    )


def cleaned(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The kept documents without their frequent lines, in the columns of ``docs``.

    ``n_chars``, where there is such a column, follows a changed text. Repeated rows stay repeated.
    """
    verdict = judged(docs, host, **limits).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("host").alias("__host"), F.col("key").alias("__key"), F.col("frequent").alias("__frequent")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("__of", F.struct(text_key(text).alias("hashes"), F.col("text").isNull().alias("missing")))
    rows = rows.withColumn("__at", F.coalesce(F.col(host).cast("string"), F.lit("")))
    kept = rows.join(
        verdict,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__at") == F.col("__host")) & (F.col("__of") == F.col("__key")),
    )
    left = F.filter(
        F.split("text", "\n"), lambda x: ~F.array_contains("__frequent", line_key(normal_line(x)))
    )
    changed = F.col("__frequent").isNotNull()
    kept = kept.withColumn("text", F.when(changed, F.concat_ws("\n", left)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT DISTINCT doc_id, coalesce(source, '') AS host, text AS t, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d
), g AS (
  SELECT doc_id, host, t, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, host, t, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, host, t, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, host, t, gram) > 1
), p AS (
  SELECT doc_id, host, t, count(DISTINCT i + k) AS n
  FROM (SELECT *, unnest([0, 1, 2]) AS k FROM r) GROUP BY doc_id, host, t
), l AS (
  SELECT doc_id, host, t, trim(regexp_replace(lower(u), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, host, t, unnest(lines) AS u FROM w)
), f AS (
  SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT t) >= {MIN_DOCS}
), x AS (
  SELECT doc_id, host, t, sum(len(string_split(line, ' '))) AS removed FROM l JOIN f USING (host, line) GROUP BY ALL
), a AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(w.text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(w.text) - length(translate(w.text, '{SYMBOLS}', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
         len(words) - coalesce(x.removed, 0) AS words_left
  FROM w
  LEFT JOIN p ON p.doc_id IS NOT DISTINCT FROM w.doc_id AND p.host = w.host AND p.t IS NOT DISTINCT FROM w.t
  LEFT JOIN x ON x.doc_id IS NOT DISTINCT FROM w.doc_id AND x.host = w.host AND x.t IS NOT DISTINCT FROM w.t
)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND 100 * words_left >= {LEFT_PERCENT} * n_words AS kept
FROM a
"""
