"""Typed parsing of the silver string contract.

Spark's own casts are more lenient than the reference's parsers in a few
places (``'1d'`` is a double, ``'2026-04'`` is a date), so every parse that
decides whether a row is valid is guarded by a plain pattern first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal or exponent number, or the special values a float parser accepts.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
# Integer, optionally with a zero fraction (a JSON 12.0 is a valid count).
_INTEGER = r"^\s*[+-]?\d+(\.0*)?\s*$"
# ISO date, optional time, optional fraction, optional zone (Z, +07, +07:00, +0700).
_ISO_DATETIME = (
    r"^(\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?)"
    r"\s*(Z|[+-]\d{2}(:?\d{2})?)?$"
)

# Month and weekday names, and words and endings without meaning in a date.
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH_NUMBERS = {name: i + 1 for i, full in enumerate(_MONTHS) for name in (full, full[:3])} | {"sept": 9}
_NOISE = (r"\b(mon(day)?|tues?(day)?|wed(nesday)?|thu(rs?)?(sday)?|fri(day)?|sat(urday)?|sun(day)?|at|on|and|of|the|ad)\b"
          r"|(?<=\d)(st|nd|rd|th)\b|(?<=\d)t(?=\s|$)|[,;.'/\-]")
# A clock time (with am or pm, a fraction and a zone), or an hour with am or pm.
_CLOCK = (r"(?<!\d)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?:\s*([ap])\.?m\b\.?)?"
          r"(?:\s*(?:z|utc|gmt)\b)?(?:\s*[+-]\d{2}(?::?\d{2})?(?!\d))?")
_HOUR = r"(?<!\d)(\d{1,2})\s*([ap])\.?m\b\.?"
# Two-digit years are those from 1976 to 2075.
_LAST_2000 = 75


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_double(x) -> Column:
    """String -> double, null unless the whole text is a number."""
    s = _c(x).cast("string")
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def safe_bigint(x) -> Column:
    """String -> bigint, null unless the text is an integer (``12.0`` allowed)."""
    s = _c(x).cast("string")
    return F.when(s.rlike(_INTEGER), F.regexp_replace(F.trim(s), r"\.0*$", "").try_cast("bigint"))


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _resolved(tokens: Column) -> Column:
    """``yyyy-MM-dd`` text of the tokens of a date (null if they are none)."""
    months = F.create_map(*[F.lit(v) for pair in _MONTH_NUMBERS.items() for v in pair])

    def year(t: Column) -> Column:
        n = t.try_cast("int")
        return F.when(F.length(t) == 4, n).when(F.length(t) <= 2, n + F.when(n > _LAST_2000, 1900).otherwise(2000))

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.format_string("%04d-%02d-%02d", year(y), m.try_cast("int"), d.try_cast("int"))

    def far(t: Column) -> Column:  # too large for a day or a month: a year
        return (F.length(t) > 2) | (t.try_cast("int") > 31)

    def three(t: Column) -> Column:
        a, b, c = (F.get(t, F.lit(i)) for i in range(3))
        month = [F.try_element_at(months, x) for x in (a, b, c)]
        number = [x.rlike("^[0-9]{1,4}$") for x in (a, b, c)]
        return (F.when(month[0].isNotNull() & number[1] & number[2], F.when(far(b), day(b, month[0], c)).otherwise(day(c, month[0], b)))
                .when(number[0] & month[1].isNotNull() & number[2], F.when(far(a), day(a, month[1], c)).otherwise(day(c, month[1], a)))
                .when(number[0] & number[1] & month[2].isNotNull(), F.when(far(b), day(b, month[2], a)).otherwise(day(a, month[2], b)))
                .when(number[0] & number[1] & number[2], F.when(far(a), day(a, b, c)).when(a.try_cast("int") > 12, day(c, b, a)).otherwise(day(c, a, b))))

    def one(t: Column) -> Column:
        run = F.get(t, F.lit(0))
        cut = [F.substring(run, i, n) for i, n in ((1, 4), (5, 2), (7, 2))]
        short = [F.substring(run, i, 2) for i in (1, 3, 5)]
        return F.when(run.rlike("^([0-9]{8}|[0-9]{12}|[0-9]{14})$"), day(*cut)).when(run.rlike("^[0-9]{6}$"), day(*short))
    return let(tokens, lambda t: F.when(F.size(t) == 3, three(t)).when(F.size(t) == 1, one(t)))


def _clock(text: Column) -> Column:
    """``HH:mm:ss.f`` text of the clock time in a text (midnight if there is none, null if it is no time)."""
    def clock(t: Column) -> Column:
        h, m, s, f, half = (F.regexp_extract(t, _CLOCK, i) for i in range(1, 6))
        run = F.regexp_extract(t, r"^[0-9]{8}([0-9]{4}|[0-9]{6})$", 1)
        hour, of_day = F.regexp_extract(t, _HOUR, 1), F.regexp_extract(t, _HOUR, 2)

        def at(h: Column, m: Column, s: Column, half: Column) -> Column:
            n = h.try_cast("int")
            return F.when((half != "") & (n.between(1, 12)), F.format_string("%02d:%s:%s", n % 12 + F.when(half == "p", 12).otherwise(0), m, s)) \
                .when((half == "") & n.between(0, 23), F.format_string("%02d:%s:%s", n, m, s))
        return (F.when(h != "", F.concat(at(h, m, F.when(s == "", "00").otherwise(s), half), F.when(f != "", F.concat(F.lit("."), f)).otherwise("")))
                .when(hour != "", at(hour, F.lit("00"), F.lit("00"), of_day))
                .when(run != "", at(F.substring(run, 1, 2), F.substring(run, 3, 2), F.rpad(F.substring(run, 5, 2), 2, "0"), F.lit("")))
                .otherwise("00:00:00"))
    return let(text, clock)


def free_form_timestamp(s: Column) -> Column:
    """A date in free form, with or without a time, null if it cannot be told.

    The clock time is cut out first. What is left is split into number and
    name tokens; weekdays, ordinal endings, small words and signs are dropped.
    Three tokens are a date, by these rules in turn: a month name is the
    month, and of the two numbers one above 31 or of four digits is the year,
    else the later one is (after a leading month name: month day year; at
    the end: year day month). Three numbers: year month day if the first must be a
    year, day month year if it is above 12, else month day year. One number of
    8 (12, 14) digits is year month day (hour minute second), one of 6 is a
    two-digit year, month and day. Two-digit years lie from 1976 to 2075.
    Dates without a year, month or day are not completed from today's."""
    def parse(t: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, _CLOCK, " "), _HOUR, " "), _NOISE, " ")
        tokens = F.filter(F.split(bare, r"\s+|(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])"), lambda x: x != "")
        return F.concat(_resolved(tokens), F.lit(" "), _clock(t)).try_cast("timestamp_ntz")
    return let(F.lower(F.trim(s)), parse)


def flexible_timestamp(x) -> Column:
    """Parse an ISO-8601 datetime (date only, ``T`` or blank, fraction, zone),
    or a date in free form (``free_form_timestamp``).

    The written wall clock is kept (zone-less result): a zone suffix is checked
    but not applied, which equals what cutting the first 10 or 19 characters
    gives in staging. Last resort, as in the reference's parser fallback: cut
    at the first ``+``, trim, and parse again.
    """
    s = F.trim(_c(x).cast("string"))

    def parse(t: Column) -> Column:
        body = F.regexp_extract(t, _ISO_DATETIME, 1)
        return F.when(body != "", body.try_cast("timestamp_ntz"))

    cut = F.trim(F.substring_index(s, "+", 1))
    return F.coalesce(parse(s), parse(cut), free_form_timestamp(s), free_form_timestamp(cut))


def date_prefix(x) -> Column:
    """``CAST(SUBSTRING(x, 1, 10) AS DATE)`` (raises on bad input under ANSI)."""
    return F.substring(_c(x).cast("string"), 1, 10).cast("date")


def timestamp_prefix(x) -> Column:
    """``CAST(SUBSTRING(CAST(x AS VARCHAR), 1, 19) AS TIMESTAMP)``, zone-less."""
    return F.substring(_c(x).cast("string"), 1, 19).cast("timestamp_ntz")


def iso_seconds(x) -> Column:
    """Datetime -> ISO-8601 text to the second, the silver string form."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss")
