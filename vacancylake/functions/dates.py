"""Date and duration rules. All of them assume a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake.functions.binding import let
from vacancylake.functions.text import blank_to_null, strip

# Relative-date units, tried in this order, in seconds.
RELATIVE_UNITS = [
    ("day", 86_400),
    ("hour", 3_600),
    ("week", 604_800),
    ("month", 2_592_000),
]

# Absolute layouts a listing page may use, tried in order, each
# with the shape a text must have to be worth parsing.
LOOSE_LAYOUTS = [
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("MMMM d, yyyy", r"^[A-Za-z]{4,} \d{1,2}, \d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
]

#: The extended form, which most feeds use and which needs no spelling out.
_USUAL = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?"

_OFFSET = r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)?"
_ISO_SHAPES = "|".join(
    [
        r"\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?",
        r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?" + _OFFSET,
        r"\d{4}-\d{2}-\d{2}[T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?" + _OFFSET,
    ]
)

# Spelling ISO basic and shortened forms out in full, so one cast reads them all.
_ISO_SPELLING = [
    (r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(\d{2})(\d{2})(?!\d)", "$1:$2:$3"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(\d{2})(?!\d)", "$1:$2"),
    (r"^(\S{10}[T ]\d{2})(?=$|Z|[+-])", "$1:00"),
    (r"^(\S{10}[T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00"),
    (r"(\d),(\d)", "$1.$2"),
    (r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"([T ].*[+-]\d{2})$", "$1:00"),
]


def _iso_instant(text: Column) -> Column:
    def spelled_out(value: Column) -> Column:
        for pattern, spelling in _ISO_SPELLING:
            value = F.regexp_replace(value, pattern, spelling)
        return value

    return F.when(text.rlike(f"{_USUAL}$"), text.try_cast("timestamp")).otherwise(
        let(
            spelled_out(text),
            lambda full: F.when(full.rlike(f"^({_ISO_SHAPES})$"), full.try_cast("timestamp")),
        )
    )


def parse_posted_at(col: Column) -> Column:
    """ISO-8601 text to a UTC instant; null when blank or unreadable."""
    read = let(F.upper(blank_to_null(col)), _iso_instant)
    return F.when(col.rlike(rf"{_USUAL}\z"), col.try_cast("timestamp")).otherwise(read)


def posted_at_rejected(col: Column) -> Column:
    """True when there is a date text that cannot be read."""
    return blank_to_null(col).isNotNull() & parse_posted_at(col).isNull()


def parse_loose_date(col: Column, now: Column) -> Column:
    """Relative or absolute date as shown on a listing page; null if neither."""

    def relative(lowered: Column) -> Column:
        rule = F.when(lowered.contains("today"), now).when(
            lowered.contains("yesterday"), now - F.expr("INTERVAL 1 DAY")
        )
        for unit, seconds in RELATIVE_UNITS:
            pattern = rf"(\d+)\s+{unit}"
            amount = F.regexp_extract(lowered, pattern, 1).try_cast("bigint")
            back = F.timestamp_micros(F.unix_micros(now) - amount * (seconds * 1_000_000))
            rule = rule.when(lowered.rlike(pattern), back)
        return rule

    def absolute(text: Column) -> Column:
        # Parsing is tried only on a fitting shape: a failed parse costs an
        # exception inside the engine.
        rule = F.when(
            text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[Tt]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?[Zz]?$"),
            F.upper(text).try_cast("timestamp"),
        )
        for layout, shape in LOOSE_LAYOUTS:
            rule = rule.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)))
        return rule

    squeezed = F.regexp_replace(strip(col), r"\s+", " ")
    return let(
        squeezed,
        lambda text: F.when(
            text != "", F.coalesce(let(F.lower(text), relative), absolute(text))
        ),
    )


def iso_text(instant: Column) -> Column:
    """ISO-8601 with a UTC offset; microseconds only when there are any."""
    return F.concat(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(
            F.unix_micros(instant) % 1_000_000 != 0, F.date_format(instant, ".SSSSSS")
        ).otherwise(F.lit("")),
        F.lit("+00:00"),
    )


def iso_or_original(col: Column, now: Column) -> Column:
    """ISO text of a loose date, the text itself if unreadable, null if empty."""
    present = F.when(col != "", col)
    return F.coalesce(let(parse_loose_date(present, now), iso_text), present)


def duration_seconds(started: Column, finished: Column) -> Column:
    return (F.unix_micros(finished) - F.unix_micros(started)) / F.lit(1_000_000.0)


def duration_ms(started: Column, finished: Column) -> Column:
    """Whole milliseconds, truncated towards zero."""
    micros = F.unix_micros(finished) - F.unix_micros(started)
    return (F.signum(micros) * F.floor(F.abs(micros) / 1000)).cast("bigint")
