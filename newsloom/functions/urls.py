"""URL clean-up so that copies of one article share one address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import groups, let, lit_array

# Query parameters that only track where a reader came from.
TRACKING_PREFIXES = ("utm_", "ito", "at_")
TRACKING_KEYS = (
    "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "cmpid", "smid",
    "_hsenc", "_hsmi", "sh",
)

_PARTS = (r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?"
          r"([^?#]*)(?:\?([^#]*))?(?:#.*)?$")
_SCHEMES_WITH_HOST = ("http", "https", "ftp", "file", "sftp", "ws", "wss")


def decode_component(text: Column) -> Column:
    """Percent- and plus-decoding that leaves broken escapes as they are."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def encode_component(text: Column) -> Column:
    """Form encoding with ``-._~`` left alone."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _is_tracking(key: Column) -> Column:
    low = F.lower(key)
    hit = F.array_contains(lit_array(TRACKING_KEYS), low)
    for prefix in TRACKING_PREFIXES:
        hit = hit | low.startswith(prefix)
    return hit


def clean_query(query: Column) -> Column:
    """Query string without tracking parameters, order kept, re-encoded."""
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(pieces, lambda p: F.struct(
        decode_component(F.regexp_extract(p, "(?s)^([^=]*)", 1)).alias("k"),
        decode_component(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(pairs, lambda p: ~_is_tracking(p["k"]))
    return F.array_join(F.transform(
        kept, lambda p: F.concat(encode_component(p["k"]), F.lit("="),
                                 encode_component(p["v"]))), "&")


def _rebuild(p: Column) -> Column:
    """Address from its raw parts: scheme, host, path, query."""
    host = F.regexp_replace(F.lower(p["host"]), r"^www\.", "")
    bare = F.regexp_replace(p["path"], "/+$", "")
    path = F.when(bare == "", F.lit("/")).otherwise(bare)
    rootless = F.array_contains(lit_array(_SCHEMES_WITH_HOST), p["scheme"]) & p["path"].startswith("/")
    return F.concat(
        F.when(p["scheme"] == "", F.lit("")).otherwise(F.concat(p["scheme"], F.lit(":"))),
        F.when((host != "") | rootless | ((bare == "") & F.array_contains(lit_array(_SCHEMES_WITH_HOST), p["scheme"])),
               F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        path,
        F.when(p["query"] == "", F.lit("")).otherwise(F.concat(F.lit("?"), p["query"])))


def canonicalize_url(url: Column) -> Column:
    """Lower-case scheme and host without ``www.``, no trailing slash, no
    fragment and no tracking parameters.  NULL and '' become NULL."""
    trimmed = F.regexp_replace(url, r"(?U)^[\s\x00-\x20]+|[\s\x00-\x20]+$", "")

    def from_parts(p: Column) -> Column:
        named = F.struct(F.lower(p[0]).alias("scheme"), p[1].alias("host"),
                         p[2].alias("path"),
                         F.when(p[3] == "", F.lit("")).otherwise(clean_query(p[3])).alias("query"))
        return F.when(F.contains(p[1], F.lit("[")) == F.contains(p[1], F.lit("]")),
                      let(named, _rebuild))

    rebuilt = let(groups(F.regexp_replace(trimmed, r"[\t\r\n]", ""), _PARTS, 4), from_parts)
    return F.when(url != "", F.coalesce(rebuilt, trimmed))


def article_id(canonical_url: Column, url: Column) -> Column:
    """Stable 32-digit identifier of an article."""
    return F.substring(F.sha2(F.coalesce(canonical_url, url), 256), 1, 32)


def relay_url(query: Column, hl: str = "en-GB", gl: str = "GB",
              ceid: str = "GB:en") -> Column:
    """Search-feed address for a publisher that blocks its own feed.
    Blanks become ``%20`` and slashes stay."""
    quoted = F.replace(F.replace(encode_component(query), F.lit("+"), F.lit("%20")),
                       F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit("https://news.google.com/rss/search?q="), quoted,
                    F.lit(f"&hl={hl}&gl={gl}&ceid={ceid}"))
