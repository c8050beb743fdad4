"""Lenient dates. All expressions assume the session time zone is UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted layouts besides ISO 8601, tried in this order.
RFC_2822 = r"^(?:[A-Za-z]{3}, *)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}).*$"
RFC_OFFSET = r"^(?:[A-Za-z]{3}, *)?\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} *([+-]\d{4})\b.*$"
LAYOUTS = {
    "M/d/yyyy HH:mm:ss": r"^\d+/\d+/\d{4} \d+:\d+:\d+$",
    "M/d/yyyy HH:mm": r"^\d+/\d+/\d{4} \d+:\d+$",
    "M/d/yyyy": r"^\d+/\d+/\d{4}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "MMMM d, yyyy": r"^[A-Za-z]+ \d{1,2}, \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3}-\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
}
# The words of the token grammar.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
MONTH = (
    r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
    r"|nov(?:ember)?|dec(?:ember)?)\b"
)
ZONE = r"(?: *(?:z|utc|gmt|[ecmp][sd]t)\b)?(?: *([+-]\d{2}:?\d{2})\b)?"
CLOCK = r"(?:t|\b)(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?)\d*)?(?: *([ap])\.?m\b\.?)?" + ZONE
BARE_HOUR = r"\b(\d{1,2})( *)()([ap])\.?m\b\.?" + ZONE
FILLERS = r"\b(?:mon(?:day)?|tues?(?:day)?|wed(?:nesday)?|thu(?:rs?(?:day)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?|at|on|of|the)\b|\(.*\)"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


#: The last year that two digits stand for.
LAST_SHORT_YEAR = 2075


def _layout(col: Column, layout: str) -> Column:
    return F.try_to_timestamp(col, F.lit(layout)).cast("timestamp_ntz")


def _iso(text: Column) -> Column:
    """ISO text with the fraction cut to microseconds, finer than which no time is stored."""
    return F.when(text.rlike(ISO_SHAPE), F.regexp_replace(text, r"(\.\d{6})\d+", "$1"))


def _bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), make), 1)


def _clock(low: Column) -> list[Column]:
    """Hour, minute, second, half of the day, offset of a text's clock, and the text without it."""
    full = low.rlike(CLOCK)
    part = lambda k: F.when(full, F.regexp_extract(low, CLOCK, k)).otherwise(F.regexp_extract(low, BARE_HOUR, k))
    found = [F.nullif(F.trim(part(k + 1)), F.lit("")).alias(n) for k, n in enumerate(("hour", "minute", "second", "half", "offset"))]
    rest = F.when(full, F.regexp_replace(low, CLOCK, " ")).otherwise(F.regexp_replace(low, BARE_HOUR, " "))
    return [*found, rest.alias("rest")]


def _by_tokens(text: Column) -> Column:
    """Wall-clock time from a date in any order of its tokens, with or without a clock.

    A month by name takes the month's place; of the two numbers left the one with four digits, or over 31, is the
    year, else the last. Three numbers are year, month, day if the first is a year, else day, month, year if it
    is over 12, else month, day, year. A part that is missing, stands twice or has no meaning gives null.
    """
    value = lambda t: t.try_cast("int")
    is_year = lambda t: (F.length(t) > 2) | (value(t) > 31)

    def tokens(clock: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(clock["rest"], FILLERS, " "), r"\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")
        return _bound(F.trim(F.regexp_replace(rest, r"[\s,./-]+", " ")), lambda rest: _bound(named_and_numbers(rest), lambda p: date(p, clock)))

    def named_and_numbers(rest: Column) -> Column:
        name = F.when(F.regexp_count(rest, F.lit(MONTH)) == 1, F.regexp_extract(rest, MONTH, 1))
        numbers = F.trim(F.regexp_replace(F.regexp_replace(rest, MONTH, " "), " +", " "))
        parts = F.when(numbers.rlike(r"^\d{1,4}( \d{1,4}){1,2}$") & (name.isNotNull() | ~rest.rlike(MONTH)), F.split(numbers, " "))
        return F.struct(name.alias("name"), parts.alias("parts"))

    def date(p: Column, clock: Column) -> Column:
        name, parts = p["name"], p["parts"]
        a, b, c = (F.get(parts, F.lit(k)) for k in range(3))
        leads, none = is_year(a), F.lit(None).cast("string")
        triple = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
        month = (F.floor(F.instr(F.lit(MONTHS), F.substring(name, 1, 3)) / 4) + 1).cast("string")
        found = (
            F.when(name.isNotNull() & (F.size(parts) == 2), F.when(leads, triple(a, month, b)).otherwise(triple(b, month, a)))
            .when(name.isNotNull() | (F.size(parts) != 3), triple(none, none, none))
            .when(leads, F.when(value(b) > 12, triple(a, c, b)).otherwise(triple(a, b, c)))
            .when(value(a) > 12, triple(c, b, a))
            .otherwise(triple(c, a, b))
        )
        return _bound(found, lambda d: made(d, clock))

    def made(d: Column, clock: Column) -> Column:
        short = value(d["y"]) + F.when(value(d["y"]) + 2000 > LAST_SHORT_YEAR, 1900).otherwise(2000)
        hour = value(F.coalesce(clock["hour"], F.lit("0")))
        half = F.when(hour.between(1, 12), hour % 12 + F.when(clock["half"] == "p", 12).otherwise(0))
        return F.try_make_timestamp_ntz(
            F.when(F.length(d["y"]) > 2, value(d["y"])).otherwise(short), value(d["m"]), value(d["d"]),
            F.when(clock["half"].isNull(), hour).otherwise(half), value(F.coalesce(clock["minute"], F.lit("0"))),
            F.coalesce(clock["second"], F.lit("0")).try_cast("decimal(16,6)"),
        )

    return _bound(F.lower(text), lambda low: _bound(F.struct(*_clock(low)), tokens))


def naive_timestamp(col: Column) -> Column:
    """Wall-clock time from a text; a zone is ignored, anything unreadable is null.

    ISO 8601, RFC 2822 and common layouts are read as such, all else by its tokens. A date that is not whole is
    null, as there is no day of reference to fill it from.
    """
    text = F.trim(col)
    rfc = F.nullif(F.regexp_extract(text, RFC_2822, 1), F.lit(""))
    return F.coalesce(
        _iso(text).try_cast("timestamp_ntz"),
        _layout(rfc, "d MMM yyyy HH:mm:ss"),
        *[F.when(text.rlike(shape), _layout(text, layout)) for layout, shape in LAYOUTS.items()],
        _by_tokens(text),
    )


def instant(col: Column) -> Column:
    """A point in time from a text; a text without offset counts as UTC, anything unreadable is null."""
    text = F.trim(col)
    rfc = F.nullif(F.regexp_extract(text, RFC_OFFSET, 1), F.lit(""))
    offset = F.regexp_replace(F.coalesce(rfc, _clock(F.lower(text))[4]), ":", "")
    minutes = F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 4, 2).cast("int")
    seconds = F.coalesce(F.when(offset.startswith("-"), -minutes).otherwise(minutes) * 60, F.lit(0))
    wall = naive_timestamp(text).cast("timestamp")
    return F.coalesce(_iso(text).try_cast("timestamp"), wall - F.make_dt_interval(secs=seconds))


def naive_utc(col: Column) -> Column:
    """A point in time as naive UTC wall-clock time."""
    return col.cast("timestamp_ntz")


def warehouse_timestamp(col: Column) -> Column:
    """ISO text with the +00:00 offset, null for anything unreadable."""
    return F.date_format(instant(col), "yyyy-MM-dd'T'HH:mm:ss+00:00")


def is_iso(col: Column) -> Column:
    """Whether the text is an ISO 8601 date or date-time; null is not."""
    return F.coalesce(_iso(col).try_cast("timestamp").isNotNull(), F.lit(False))


def epoch_millis(col: Column) -> Column:
    """Milliseconds since 1970 from a date text; null or unreadable gives 0."""
    iso = _iso(F.trim(col)).try_cast("timestamp")
    return F.coalesce(F.unix_millis(F.coalesce(iso, naive_timestamp(col).cast("timestamp"))), F.lit(0).cast("long"))


def epoch_number_to_millis(col: Column) -> Column:
    """Milliseconds from a number: above 1e12 it already is milliseconds, else seconds; null gives 0."""
    value = col.cast("double")
    return F.coalesce(F.when(value > 1e12, value).otherwise(value * 1000).cast("long"), F.lit(0).cast("long"))
