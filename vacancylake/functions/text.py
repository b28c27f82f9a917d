"""Scalar text rules: status, location, ids, salary, flags and redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake.functions.binding import let

# Accepted spellings of each listing status.
STATUS_ALIASES = {
    "open": ["open", "active", "live"],
    "closed": ["closed", "inactive", "expired", "filled"],
    "unknown": ["unknown", "n/a", "na", "null"],
}

# Query parameters whose value is hidden in logged URLs.
REDACTED_URL_PARAMETER = r"(?i)([?&](?:api[_-]?key|token|secret|password|auth|key|id)=)[^&]+"

# Field names whose value is hidden in logged maps.
REDACTED_FIELDS = [
    "api_key",
    "apikey",
    "api-key",
    "api_key_id",
    "auth",
    "authorization",
    "bearer",
    "client_secret",
    "password",
    "passwd",
    "private_key",
    "secret",
    "secret_key",
    "security_token",
    "session_token",
    "token",
    "x-api-key",
    "x-auth-token",
    "x-security-token",
]

# Listing-id patterns, tried in order, per source.
JOB_ID_PATTERNS = {
    "caloptima": [(r"/job/([^/?#]+)", 1)],
    "iqmetrix": [(r"/apply/([^/?#]+)", 1)],
    "absolute-security": [(r"/job/([A-Za-z0-9_-]+)", 1)],
    "techcorp": [(r"(?i)/(career|job)s?/(\d+)", 2), (r"(?i)job[_-]?id[=:]?(\d+)", 1)],
    "startupxyz": [(r"/jobs/(\d+)", 1), (r"(?i)id[=:]?(\d+)", 1)],
}

REDACTED = "<REDACTED>"

#: Every character Unicode counts as white space, as a regex class body.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _plain_ends(col: Column) -> Column:
    """Whether a text begins and ends with a visible ASCII character."""
    # looking at two characters is cheaper than matching over the whole text, and comparing cheaper than matching
    return (col >= "!") & (col < "\x7f") & F.right(col, F.lit(1)).between("!", "~")


def strip(col: Column) -> Column:
    """Trim white space of any kind from both ends."""
    ends = F.concat(F.left(col, F.lit(1)), F.right(col, F.lit(1)))
    return (
        F.when(_plain_ends(col), col)
        .when(ends.rlike(f"[{SPACE}]"), F.regexp_replace(col, f"^[{SPACE}]+|[{SPACE}]+$", ""))
        .otherwise(col)
    )


def blank_to_null(col: Column) -> Column:
    """Null for text that is empty once trimmed."""
    # most texts need no trimming, and naming a value costs more than looking at its ends
    return F.when(_plain_ends(col), col).otherwise(let(strip(col), lambda trimmed: F.when(trimmed != "", trimmed)))


def normalize_status(col: Column) -> Column:
    """Map a status spelling to open, closed or unknown; null means reject."""
    text = F.lower(strip(col))
    rule = F.lit(None).cast("string")
    for status, spellings in STATUS_ALIASES.items():
        rule = F.when(text.isin(spellings), F.lit(status)).otherwise(rule)
    return rule


def default_location(col: Column, default: str | Column = "Remote") -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(blank_to_null(col), fallback)


def first_capture(url: Column, patterns: list[tuple[str, int]]) -> Column:
    """First non-empty capture among patterns tried in order."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, g), F.lit("")) for p, g in patterns])


def source_job_id(url: Column, source: Column) -> Column:
    """Listing id cut from its URL by the source's own pattern, else null."""
    rule = F.lit(None).cast("string")
    for slug, patterns in JOB_ID_PATTERNS.items():
        rule = F.when(source == slug, first_capture(url, patterns)).otherwise(rule)
    return rule


def salary_bucket(col: Column) -> Column:
    """Band of the first two- or three-digit number in a salary text."""
    digits = F.regexp_extract(F.replace(col, F.lit(","), F.lit("")), r"(\d{2,3})", 1)
    amount = digits.try_cast("int")
    return (
        F.when(amount >= 250, "250+")
        .when(amount >= 200, "200+")
        .when(amount >= 150, "150+")
        .otherwise("")
    )


def easy_apply(raw_data: Column) -> Column:
    """``Yes`` when the payload's easy_apply is JSON true or an affirming string."""

    def affirmed(value: Column) -> Column:
        # VARIANT keeps the JSON type, so the number 1 and the string "1" differ.
        kind = F.schema_of_variant(value)
        word = F.lower(F.try_variant_get(value, "$", "string"))
        yes = ((kind == "BOOLEAN") & (word == "true")) | (
            (kind == "STRING") & word.isin("yes", "true", "1")
        )
        return F.when(yes, "Yes").otherwise("")

    value = F.try_variant_get(F.try_parse_json(raw_data), "$.easy_apply", "variant")
    # most payloads do not mention it and need no parsing
    return F.when(raw_data.contains("easy_apply"), let(value, affirmed)).otherwise("")


def salary_text(salary_raw: Column, raw_data: Column, salary: Column | None = None) -> Column:
    """First non-empty salary among the column, an optional extra and the payload."""
    empty = F.lit("")
    choices = [F.nullif(salary_raw, empty)]
    if salary is not None:
        choices.append(F.nullif(salary, empty))
    choices.append(F.nullif(F.get_json_object(raw_data, "$.salary"), empty))
    return F.coalesce(*choices, empty)


def title_fingerprint(title: Column) -> Column:
    return F.sha2(F.lower(strip(title)), 256)


def redact_url(col: Column) -> Column:
    return F.regexp_replace(col, REDACTED_URL_PARAMETER, "$1" + REDACTED)


def _field_key(name: str) -> str:
    return name.lower().strip().replace("-", "_").replace(" ", "_")


def redact_map(col: Column) -> Column:
    """Hide values of sensitive keys in a string map."""
    hidden = sorted({_field_key(name) for name in REDACTED_FIELDS})

    def rule(key: Column, value: Column) -> Column:
        flat = F.translate(F.lower(strip(key)), "- ", "__")
        return F.when(flat.isin(hidden) | flat.contains("_secret"), F.lit(REDACTED)).otherwise(value)

    return F.transform_values(col, rule)
