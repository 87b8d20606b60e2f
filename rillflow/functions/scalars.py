"""Column functions of the cleaning and session rules; all of them stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.schemas import ACTIONS

# The text forms that the usual CSV readers take for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Accepted formats and the blanks around words. (?U) gives \s and \d their Unicode
# meaning.
EMAIL_PATTERN = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$"
SESSION_PATTERN = r"(?U)^sess_\d+$"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ISO_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?$"
)
ZONED_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
)
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def blank_na(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn every NA token of the text columns into NULL."""
    return df.select(
        *[
            F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in keep
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def to_double(text: Column) -> Column:
    """Number or NULL; words such as ``NaN`` or ``inf`` and suffixed forms are no numbers."""
    return F.when(text.cast("string").rlike(NUMBER_PATTERN), text.cast("string").try_cast("double"))


def to_id(text: Column) -> Column:
    """Whole number or NULL. ``5.0`` is the id 5; ids beyond 2^53 keep all their digits."""
    number = to_double(text)
    return F.coalesce(
        text.try_cast("bigint"),
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def parse_timestamp(text: Column, zone: str = "reject") -> Column:
    """ISO date or date-time, else NULL.

    Text with a zone (``Z``, ``+02``, ``+02:00``, ``+0200``) is NULL as well, or with ``zone="utc"``
    the time it names in UTC; text without one stays as it is.
    """
    if zone not in ("reject", "utc"):
        raise ValueError(f"Unknown zone rule: {zone!r}")
    plain = F.when(text.rlike(ISO_PATTERN), text.try_cast("timestamp_ntz"))
    if zone == "reject":
        return plain
    # the cast wants seconds before a zone and a colon inside it
    full = F.regexp_replace(text, r"([T ][0-9]{2}:[0-9]{2})(Z|[+-])", "$1:00$2")
    full = F.regexp_replace(full, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    instant = F.unix_micros(full.try_cast("timestamp"))
    # no session zone takes part: microseconds since the epoch, added to it
    seconds = instant.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(20,0)")
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return plain.when(text.rlike(ZONED_PATTERN), F.expr(EPOCH) + span)


def valid_email(text: Column) -> Column:
    return F.coalesce(text.rlike(EMAIL_PATTERN), F.lit(False))


def valid_session(text: Column) -> Column:
    return F.coalesce(text.rlike(SESSION_PATTERN), F.lit(False))


def known_action(text: Column) -> Column:
    """Lower-cased action without outer blanks, NULL when it is not an accepted one."""
    plain = F.lower(F.btrim(text, F.lit(BLANKS)))
    return F.when(plain.isin(ACTIONS), plain)


def safe_ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def elapsed_seconds(start: str, end: str) -> Column:
    """Fractional seconds between two zone-free timestamps."""
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end}) / 1e6D")


def elapsed_whole_seconds(start: str, end: str) -> Column:
    """Number of second boundaries crossed, as a double."""

    def second_of(ts: str) -> str:
        return f"floor(timestampdiff(MICROSECOND, {EPOCH}, {ts}) / 1000000D)"

    return F.expr(f"cast({second_of(end)} - {second_of(start)} as double)")


def as_utc(ts: str) -> Column:
    """The zone-free time as an instant in UTC."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH}, {ts}))")


def row_json(columns: list[str]) -> Column:
    """The named columns as one JSON object, NULLs included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def first_match(rules: list[tuple[str, Column]]) -> Column:
    """Label of the first rule that holds, NULL when none does."""
    label, holds = rules[0]
    chain = F.when(holds, F.lit(label))
    for label, holds in rules[1:]:
        chain = chain.when(holds, F.lit(label))
    return chain
