"""URL identity and link resolution as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake.functions.binding import let
from vacancylake.functions.text import strip

# Query parameters that never take part in a listing's identity.
TRACKING_PARAMETERS = [
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "ref",
    "fbclid",
    "gclid",
    "msclkid",
    "_ga",
    "mc_cid",
    "oly_enc_id",
    "vero_id",
    "wickedid",
    "share_source",
    "share_medium",
    "share_campaign",
]

# The port each scheme implies.
DEFAULT_PORTS = {"https": "443", "http": "80"}

# Schemes whose last path segment may carry ``;parameters`` (RFC 2396).
_PARAMETER_SCHEMES = ["http", "https", "ftp", "sftp", "rtsp", "rtspu", "sip", "sips", "shttp", "mms"]

#: What most URLs look like: nothing to trim, an address with a host, and nothing to rewrite but for dot segments.
_VISIBLE = r"^[!-~]+\z"
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.\-]*://[!-~&&[^/?#]]"
_PLAIN = r"^https?://[a-z0-9.\-]+(?:/(?:[A-Za-z0-9_~%+,=@:.\-/]*[A-Za-z0-9_~%+,=@:.\-]))?\z"

_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def clean_url(url: Column) -> Column:
    """Trim a URL and drop the line breaks and tabs a parser ignores."""
    cleaned = let(
        F.translate(strip(url), "\t\r\n", ""),
        lambda text: F.when(text < "!", F.regexp_replace(text, r"^[\x00-\x20]+", "")).otherwise(text),
    )
    return F.when(url.rlike(_VISIBLE), url).otherwise(cleaned)


def is_absolute(url: Column) -> Column:
    """True when the URL has both a scheme and a host."""
    found = F.coalesce(clean_url(url).rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]"), F.lit(False))
    return F.when(url.rlike(_ADDRESS), F.lit(True)).otherwise(found)


def remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    joined = F.concat(
        F.array_join(kept, "/"),
        # a trailing dot segment names a directory
        F.when(path.rlike(r"(^|/)\.{1,2}$"), F.lit("/")).otherwise(F.lit("")),
    )
    rooted = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), rooted).otherwise(path)


def decode_component(text: Column) -> Column:
    """Form-decode, leaving malformed escapes as they stand."""
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def encode_component(text: Column) -> Column:
    """Form-encode keeping only letters, digits and ``_.-~``."""
    return F.replace(
        F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def canonical_query(query: Column) -> Column:
    """Drop tracking parameters, sort by key (stable) and re-encode."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda item: item != ""),
        lambda item, at: F.struct(
            decode_component(F.substring_index(item, "=", 1)).alias("key"),
            at.alias("at"),
            F.when(
                F.instr(item, "=") > 0,
                decode_component(F.regexp_replace(item, r"^[^=]*=", "")),
            )
            .otherwise(F.lit(""))
            .alias("value"),
        ),
    )
    kept = F.array_sort(
        F.filter(pairs, lambda pair: ~F.lower(pair["key"]).isin(TRACKING_PARAMETERS))
    )
    return F.array_join(
        F.transform(
            kept,
            lambda pair: F.concat(
                encode_component(pair["key"]), F.lit("="), encode_component(pair["value"])
            ),
        ),
        "&",
    )


def _split(text: Column) -> Column:
    """Scheme, host, path and query of a cleaned URL; blank where it has none."""
    return F.struct(
        F.lower(F.regexp_extract(text, _URL, 1)).alias("scheme"),
        F.lower(F.regexp_extract(text, _URL, 2)).alias("host"),
        F.regexp_extract(text, _URL, 3).alias("path"),
        F.regexp_extract(text, _URL, 4).alias("query"),
    )


def _bare_host(scheme: Column, host: Column) -> Column:
    """The host without the port its scheme implies."""
    rule = host
    for name, port in DEFAULT_PORTS.items():
        rule = F.when(
            (scheme == name) & host.endswith(f":{port}"), F.regexp_replace(host, f":{port}$", "")
        ).otherwise(rule)
    return rule


def _bare_path(scheme: Column, path: Column) -> Column:
    """The path without dot segments and without its last segment's parameters."""
    plain = F.when(
        path.contains(";") & scheme.isin(_PARAMETER_SCHEMES),
        F.regexp_replace(path, r";[^/]*$", ""),
    ).otherwise(path)
    return F.when(path.contains("/."), let(plain, remove_dot_segments)).otherwise(plain)


def _assemble(part: Column) -> Column:
    scheme, host, query = part["scheme"], part["host"], part["query"]
    base = F.concat(
        scheme, F.lit("://"), _bare_host(scheme, host), _bare_path(scheme, part["path"])
    )
    kept = F.when(query != "", canonical_query(query)).otherwise(F.lit(""))
    whole = let(
        F.struct(base.alias("base"), kept.alias("kept")),
        lambda made: F.when(
            made["kept"] != "", F.concat(made["base"], F.lit("?"), made["kept"])
        ).otherwise(F.regexp_replace(made["base"], "/+$", "")),
    )
    balanced = host.contains("[") == host.contains("]")
    return F.when((scheme != "") & (host != "") & balanced, whole)


def canonicalize_url(url: Column) -> Column:
    """Canonical form of a listing URL; null when it has no scheme or host."""
    return let(clean_url(url), canonicalize_clean_url)


def canonicalize_clean_url(text: Column) -> Column:
    """The same for text that :func:`clean_url` has been applied to."""
    plain = text.rlike(_PLAIN) & ~text.contains("/.")
    return F.when(plain, text).otherwise(let(_split(text), _assemble))


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve a link against the page it was found on."""
    scheme = F.lower(F.regexp_extract(base, _URL, 1))
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _URL, 2))
    base_path = F.regexp_extract(base, _URL, 3)
    base_query = F.regexp_extract(base, r"(\?[^#]*)", 1)
    folder = F.regexp_replace(F.when(base_path == "", F.lit("/")).otherwise(base_path), r"[^/]*$", "")
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"([?#].*)$", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href == "", base)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, remove_dot_segments(link_path), tail))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .when(href.startswith("#"), F.concat(origin, base_path, base_query, href))
        .otherwise(F.concat(origin, remove_dot_segments(F.concat(folder, link_path)), tail))
    )


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 2))
