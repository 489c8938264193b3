"""Column functions on text and dates. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.constants import REPORT_UTC_OFFSET_HOURS

# Fixed value: every character that counts as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove blanks of any script from both ends (plain ``trim`` knows U+0020 only)."""
    return F.trim(text, F.lit(BLANKS))


def strip_or_empty(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def normalize_url(url: Column) -> Column:
    """Drop every trailing slash, then lower-case. Query and fragment stay."""
    return F.lower(F.rtrim(url, F.lit("/")))


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL, without user part and port; empty when there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def in_domains(host: Column, domains: Sequence[str]) -> Column:
    """True when ``host`` is one of ``domains`` or lies below one of them."""
    hit = F.lit(False)
    for domain in domains:
        d = domain.lower()
        hit = hit | (host == d) | host.endswith("." + d)
    return hit


def occurrences(text: Column, phrase: str) -> Column:
    """How often ``phrase`` occurs in ``text``, without overlaps. Case matters."""
    gone = F.replace(text, F.lit(phrase), F.lit(""))
    count = ((F.length(text) - F.length(gone)) / F.lit(len(phrase))).cast("bigint")
    return F.when(F.contains(text, F.lit(phrase)), count).otherwise(F.lit(0).cast("bigint"))


#: ISO-8601 in one pattern: calendar or week date, with or without hyphens; then any one character
#: and a time of day, with or without colons; then an offset. A text is basic or extended throughout
#: its date, its time and its offset each.
_ISO = (
    r"(?s)^(?!0000)(\d{4})(-?)(?:(\d{2})\2(\d{2})|W(\d{2})(?:\2(\d))?)"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\8(\d{2})(?:[.,](\d*))?)?)?"
    r"(?:(Z)|([+-])(\d{2})(?:(:?)(\d{2})(?:\15(\d{2})(?:[.,](\d*))?)?)?)?)?\z"
)
_FIELDS = ("year", "month", "day", "week", "weekday", "hour", "minute", "second", "fraction", "utc", "sign")
_FIELDS += ("offset_hour", "offset_minute", "offset_second", "offset_fraction")
_GROUPS = (1, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 16, 17, 18)


def read_time(text: Column) -> Column:
    """Struct of ``micros`` since 1970 (null: unreadable) and ``assumed_utc`` for an ISO-8601 text.

    The fields are cut out by one pattern and put together by integer arithmetic, so nothing depends
    on the session. A text without an offset is read as UTC, and flagged.
    """
    spelt = F.regexp_replace(text, _ISO, "\n" + ";".join(f"${g}" for g in _GROUPS))
    matched = F.startswith(spelt, F.lit("\n")) & ~F.startswith(text, F.lit("\n"))
    return _bound(F.when(matched, F.split(F.substring(spelt, 2, 1 << 20), ";", -1)), _assemble)


def _assemble(parts: Column) -> Column:
    raw = {name: parts[i] for i, name in enumerate(_FIELDS)}

    def number(name: str, default: int = 0) -> Column:
        return F.coalesce(raw[name].try_cast("int"), F.lit(default))

    def fraction(name: str) -> Column:
        return F.rpad(F.substring(raw[name], 1, 6), 6, "0").cast("bigint")

    calendar = F.unix_date(F.concat_ws("-", raw["year"], raw["month"], raw["day"]).try_cast("date"))
    fourth = F.unix_date(F.concat(raw["year"], F.lit("-01-04")).try_cast("date"))
    first_monday = fourth - F.pmod(fourth + 3, F.lit(7))
    week, weekday = number("week"), number("weekday", 1)
    # Week 53 exists when its Thursday lies in the same year.
    thursday = F.year(F.date_from_unix_date(first_monday + (week - 1) * 7 + 3))
    exists = week.between(1, 53) & weekday.between(1, 7) & (thursday == number("year"))
    days = F.when(raw["week"] == "", calendar).when(exists, first_monday + (week - 1) * 7 + weekday - 1)
    timed = (number("hour") < 24) & (number("minute") < 60) & (number("second") < 60)
    zoned = (number("offset_hour") < 24) & (number("offset_minute") < 60) & (number("offset_second") < 60)
    seconds = number("hour") * 3600 + number("minute") * 60 + number("second")
    sign = F.when(raw["sign"] == "-", -1).otherwise(1)
    offset = number("offset_hour") * 3600 + number("offset_minute") * 60 + number("offset_second")
    micros = (days.cast("bigint") * 86_400 + seconds - sign * offset) * 1_000_000
    micros = F.when(timed & zoned, micros + fraction("fraction") - sign * fraction("offset_fraction"))
    bare = (raw["utc"] == "") & (raw["sign"] == "")
    return F.struct(micros.alias("micros"), (micros.isNotNull() & bare).alias("assumed_utc"))


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null when it cannot be read; see :func:`read_time`."""
    return F.timestamp_micros(read_time(text)["micros"])


def lacks_offset(text: Column) -> Column:
    """True when a readable time carries no offset, so that UTC had to be assumed."""
    return F.coalesce(read_time(text)["assumed_utc"], F.lit(False))


def _date_at_offset(instant: Column, hours: int) -> Column:
    day = F.floor((F.unix_micros(instant) + F.lit(hours * 3_600_000_000)) / F.lit(86_400_000_000))
    return F.date_from_unix_date(day.cast("int"))


def utc_date(instant: Column) -> Column:
    """Calendar date at UTC, whatever the session time zone is."""
    return _date_at_offset(instant, 0)


def report_date(instant: Column) -> Column:
    """Calendar date at the fixed report offset, whatever the session time zone is."""
    return _date_at_offset(instant, REPORT_UTC_OFFSET_HOURS)


def japanese_date(date: Column) -> Column:
    return F.date_format(date, "yyyy年MM月dd日")


def published_label(published_at: Column) -> Column:
    """Publication time as a Japanese report date; the text itself when unreadable."""
    return F.coalesce(japanese_date(report_date(parse_instant(published_at))), published_at)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_fence(text: Column) -> Column:
    """Content of a text wrapped in a ``` code fence; other texts only lose outer blanks.

    The opening line is skipped with whatever follows the ticks; lines are taken up to the
    next line that starts with ticks, or to the end.
    """

    def is_ticks(line: Column) -> Column:
        return F.startswith(line, F.lit("```"))

    def content(lines: Column) -> Column:
        rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
        closing = F.array_position(F.transform(rest, is_ticks), F.lit(True)).cast("int")
        return F.array_join(F.when(closing > 0, F.slice(rest, F.lit(1), closing - 1)).otherwise(rest), "\n")

    return _bound(strip(text), lambda body: F.when(is_ticks(body), _bound(F.split(body, "\n"), content)).otherwise(body))
