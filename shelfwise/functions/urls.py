"""URL rules as column expressions. Invalid URLs give null (``try_parse_url``), never an exception."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

IMAGE_SUFFIX = "(?i)\\.(?:jpe?g|png|webp)$"
_SCHEME = "[A-Za-z][A-Za-z0-9+.-]*:"
# Escapes of the characters that separate the parts of a path or query
_CHARACTER = {"%2F": "/", "%3D": "=", "%26": "&"}


def _escaped(part: Column, *kept: str) -> Column:
    """UTF-8 escapes for all but unreserved characters, the codes of ``kept`` and percent signs, so that escapes stay."""
    out = F.url_encode(part)
    for code, char in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), *[(code, _CHARACTER[code]) for code in kept], ("%25", "%")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def iri_to_uri(url: Column) -> Column:
    """Percent-encode path, query and fragment and keep existing escapes.

    The scheme becomes lower case, an empty query or fragment goes; an authority with one bracket only gives null.
    """
    scheme = F.lower(F.regexp_extract(url, f"^{_SCHEME}", 0))
    server = F.regexp_extract(url, f"^(?:{_SCHEME})?(//[^/?#]*)", 1)
    names = _escaped(F.regexp_extract(url, f"^(?:{_SCHEME})?(?://[^/?#]*)?([^?#]*)", 1), "%2F")
    asked, mark = query(url), F.regexp_extract(url, "(?s)^[^#]*#(.*)$", 1)
    whole = F.concat(
        scheme,
        server,
        names,
        F.when(asked != "", F.concat(F.lit("?"), _escaped(asked, "%3D", "%26"))).otherwise(""),
        F.when(mark != "", F.concat(F.lit("#"), _escaped(mark))).otherwise(""),
    )
    return F.when(server.contains("[") == server.contains("]"), whole)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)


def canonical_image_url(url: Column, site_host: str) -> Column:
    """Same-host image without size suffix, query or fragment, always https; null for anything else."""
    scheme_ok = url.rlike("(?i)^https?://")
    clean_path = F.regexp_replace(path(url), "(?i)-\\d{2,5}x\\d{2,5}(?=\\.(?:jpe?g|png|webp)$)", "")
    keep = scheme_ok & (host(url) == site_host) & clean_path.rlike(IMAGE_SUFFIX)
    return F.when(keep, F.concat(F.lit("https://"), authority(url), clean_path))


def product_id_in_path(url: Column) -> Column:
    """Numeric id of a ``/product/<id>`` or ``/p/<id>`` path."""
    return F.regexp_extract(path(url), "/(?:product|p)/([0-9]+)(?:/|$)", 1).try_cast("bigint")


def base_name(value: Column) -> Column:
    return F.substring_index(value, "/", -1)
