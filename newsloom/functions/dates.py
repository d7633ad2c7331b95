"""Timestamps as feeds write them: RFC 822 or ISO 8601, anything else NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import groups, let, lit_array, sql_text

# Zone names of RFC 822 and their offsets.
ZONE_OFFSETS = {
    "AST": "-04:00", "ADT": "-03:00", "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00",
}
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun",
           "jul", "aug", "sep", "oct", "nov", "dec")

_RFC = (r"(?is)^(?:[a-z]+,?\s*)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})"
        r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([a-z]+|[+-]\d{4})?(?:\W.*)?$")
# Other orders and signs, rewritten to day, month, year, time: month first, the
# year after the time, a comma after the day, dots in the time.
_REWRITES = (
    (r"(?i)^(?:[a-z]+,?\s+)?([a-z]{3})[a-z]*\s+(\d{1,2})\s+(\d{1,2}[:.]\d{2}(?:[:.]\d{2})?)\s+(\d{4})(?!\d)(.*)$",
     "$2 $1 $4 $3$5"),
    (r"(?i)^(?:[a-z]+,?\s+)?([a-z]{3})[a-z]*\s+(\d{1,2}),?\s+(\d{4}|\d{2})\s+(.*)$", "$2 $1 $3 $4"),
    (r"(\s\d{1,2})\.(\d{2})\.(\d{2})(?!\d)", "$1:$2:$3"),
    (r"(\s\d{1,2})\.(\d{2})(?![\d.:])", "$1:$2"),
)
_ISO = (r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?"
        r"(?:[+-]\d{2}:\d{2})?)?$")


def _rfc_timestamp(text: Column) -> Column:
    names = F.expr("map(" + ", ".join(sql_text(x) for kv in ZONE_OFFSETS.items() for x in kv) + ")")
    months = lit_array(_MONTHS)

    def offset(zone: Column) -> Column:
        return (F.when(zone.rlike(r"^[+-]\d{4}$"),
                       F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
                .otherwise(F.coalesce(F.try_element_at(names, zone), F.lit("+00:00"))))

    def year(text: Column) -> Column:
        return (F.when(F.length(text) == 4, text)
                .when(text > "68", F.concat(F.lit("19"), text))
                .otherwise(F.concat(F.lit("20"), text)))

    def iso(p: Column) -> Column:
        month = F.array_position(months, F.lower(p[1])).cast("string")
        seconds = F.when(p[5] == "", F.lit("00")).otherwise(p[5])
        return F.concat_ws(
            "", year(p[2]), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"),
            F.lpad(p[0], 2, "0"), F.lit("T"), F.lpad(p[3], 2, "0"), F.lit(":"),
            p[4], F.lit(":"), seconds, offset(F.upper(p[6])))

    for pattern, form in _REWRITES:
        text = F.regexp_replace(text, pattern, form)
    return let(groups(text, _RFC, 7), iso).try_cast("timestamp")


def _iso_timestamp(text: Column) -> Column:
    # Compact dates, times and offsets are spelled out; 'Z' is the zero offset.
    spelled = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    for pattern, full in ((r"^(\d{4})(\d{2})(\d{2})(?=T|$)", "$1-$2-$3"),
                          (r"T(\d{2})(\d{2})(\d{2})", "T$1:$2:$3"),
                          (r"([+-]\d{2})(\d{2})$", "$1:$2")):
        spelled = F.regexp_replace(spelled, pattern, full)

    def first_valid(s: Column) -> Column:
        tries = F.array(s, F.substring(s, 1, 19), F.substring(s, 1, 10))
        times = F.transform(tries, lambda c: F.when(c.rlike(_ISO), c.try_cast("timestamp")))
        return F.try_element_at(F.array_compact(times), F.lit(1))

    return let(spelled, first_valid)


def parse_datetime(text: Column) -> Column:
    """Timestamp of a feed date; a date without zone is UTC."""
    trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return let(trimmed, lambda t: F.when(t.rlike(r"^\d{4}"), _iso_timestamp(t))
               .otherwise(_rfc_timestamp(t)))


def date_from_html(html: Column) -> Column:
    """Timestamp in the first ``datetime="…"`` attribute of an HTML body."""
    return parse_datetime(F.regexp_extract(html, r"""(?i)datetime=["']([^"']+)["']""", 1))


def iso_utc(ts: Column) -> Column:
    """ISO text of a timestamp with ``+00:00``; the fraction only if not zero."""
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(fraction == "000000", F.lit(""))
                    .otherwise(F.concat(F.lit("."), fraction)),
                    F.lit("+00:00"))
