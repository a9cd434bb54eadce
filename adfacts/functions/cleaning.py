"""Column helpers that turn export text into typed values.

Every helper takes and returns a ``Column``. Bad input becomes NULL (or 0 for
counts), never an error and never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell texts that a CSV export uses for "missing".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Code points that count as white space (Unicode, plus the four
# ASCII separators 28-31). Spark's plain trim removes blanks only.
WHITESPACE = "".join(
    chr(code)
    for code in [
        *range(9, 14),
        *range(28, 33),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

# Dates are parsed in two steps: replacements bring a text to one of the shapes below, and one
# pattern with an optional section per shape reads them all. What most exports write is read
# straight away. Month comes first; a number above 12 in first place is the day.
COMMON_YEAR = r"(?:1[7-9]|20|21)\d{2}"
COMMON_DATES = [
    (rf"^{COMMON_YEAR}-\d{{1,2}}-\d{{1,2}}$", None),  # cast
    (rf"^(?:0?[1-9]|1[0-2])/\d{{1,2}}/{COMMON_YEAR}$", "M/d/yyyy"),
    (rf"^\d{{1,2}}-\p{{L}}{{3}}-{COMMON_YEAR}$", "d-MMM-yyyy"),
]
YEAR_LESS_69 = r"0\d|[1-5]\d|6[0-8]"
DATE_STEPS: list[tuple[str, str]] = [
    # a weekday in front
    (r"^(?i:mon|tue|wed|thu|fri|sat|sun)\p{L}*,? (?=\p{L}|\d)", ""),
    # Sept, 5th, the dot of Jan. and the comma behind a day
    (r"(?i)t(?<=\bsept)\b\.?|(?:st|nd|rd|th)\b(?<=\d..)|\.(?= )(?<=\b\p{L}{3}\.)|,(?= \d)", ""),
    # two-digit years: up to 68 they are 20xx, from 69 19xx
    (rf"^(\d{{1,2}}([/.-])(?:\d{{1,2}}|\p{{L}}+)\2)((?:{YEAR_LESS_69})(?!\d))", "$120$3"),
    (r"^(\d{1,2}([/.-])(?:\d{1,2}|\p{L}+)\2)(\d{2}(?!\d))", "$119$3"),
    # numbers only
    (r"^(1[3-9]|[23]\d)([/.-])(\d{1,2})\2(\d{4})(?!\d)", "$3/$1/$4"),
    (r"^(\d{1,2})([.-])(\d{1,2})\2(\d{4})(?!\d)", "$1/$3/$4"),
    (r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})(?!\d)", "$1-$3-$4"),
    # month names between blanks, hyphens, dots or nothing: a blank on either side
    (r"^(\d+)[ ./-]?(\p{L}{3,9})[ ./-]?(\d+)(?!\d)", "$1 $2 $3"),
    (r"^(\p{L}{3,9})[ ./-]?(\d{1,2})[ ./-](\d{4})(?!\d)", "$1 $2 $3"),
    # a compact time, an hour alone, zones by name, and no zone at all, which counts as UTC
    (r"(?<=^\d{8}T)(\d{2})(\d{2})(\d{2})(?!\d)", "$1:$2:$3"),
    (r"(?<=\d[ T]\d{1,2})(?=$|Z|[+-]\d)", ":00"),
    (r"(?<=\d)(?: ?[Zz]| (?:UTC|GMT))$", "Z"),
    (r"$(?<!Z|:\d{2}(?:\.\d{1,9})? ?[+-]\d{2}(?::?\d{2})?)", "Z"),
]
DATE_SHAPE = (
    r"^(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{8}|\d{1,2} \p{L}{3,9} \d{4}"
    r"|\d{4} \p{L}{3,9} \d{1,2}|\p{L}{3,9} \d{1,2} \d{4})"
    r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?: ?[AaPp][Mm])?)?(?:Z| ?[+-]\d{2}(?::?\d{2})?)$"
)
DATE_PATTERN = (
    "[yyyy-M-d][M/d/yyyy][yyyyMMdd][d MMMM yyyy][d MMM yyyy][yyyy MMMM d][yyyy MMM d]"
    "[MMMM d yyyy][MMM d yyyy]"
    "[ h:mm[:ss][ ]a]['T'h:mm[:ss][ ]a][ H:mm[:ss[.SSSSSSSSS]]]['T'H:mm[:ss[.SSSSSSSSS]]][ ]"
    "[XXX][XX][X]"
)
# Times are what a count of nanoseconds in 64 bits can hold.
NANOS_PER_MICRO = 1000

# A plain decimal number. Anything else is malformed: 12d, 0x1A, inf and NaN, which Spark's
# own cast would let through.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(column: str) -> Column:
    """The named text column with the texts above as NULL.

    Stated as SQL text: one call instead of one per literal, for every column read.
    """
    name = "`" + column.replace("`", "``") + "`"
    tokens = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return F.expr(f"CASE WHEN {name} NOT IN ({tokens}) THEN {name} END")


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def strip_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def to_double(text: Column) -> Column:
    """Decimal text to a finite number; malformed text, or one too large, is NULL."""
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_count(text: Column) -> Column:
    """Decimal text to a whole number, cut toward zero; malformed text is 0."""
    return F.coalesce(to_double(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_date_time(text: Column, extra_patterns: Sequence[tuple[str, list[str]]] = ()) -> Column:
    """Date text without outer blanks to a timestamp without time zone.

    A text with a zone offset is converted to UTC. Shapes not listed above, or in
    ``extra_patterns`` (a test of the whole text, and the patterns to try), are NULL.
    """

    def parsed(text: Column) -> Column:
        (plain, _), *common = COMMON_DATES
        dates = F.when(text.rlike(plain), text.try_cast("date"))
        for shape, pattern in common:
            dates = dates.when(text.rlike(shape), F.try_to_date(text, pattern))
        extra = [
            F.when(text.rlike(shape), F.try_to_date(text, pattern)).cast("timestamp_ntz")
            for shape, patterns in extra_patterns
            for pattern in patterns
        ]
        return F.coalesce(dates.cast("timestamp_ntz"), _any_date_time(text), *extra)

    # As the body of a function on one element, the text is computed once and the steps stay out
    # of the code that Spark generates for the row, which would be too long to be compiled.
    return F.get(F.transform(F.array(text), parsed), F.lit(0))


def _any_date_time(text: Column) -> Column:
    for shape, replacement in DATE_STEPS:
        text = F.regexp_replace(text, shape, replacement)
    instant = F.try_to_timestamp(F.regexp_substr(text, F.lit(DATE_SHAPE)), F.lit(DATE_PATTERN))
    # the product is NULL beyond 64 bits
    nanos = F.try_multiply(F.unix_micros(instant), F.lit(NANOS_PER_MICRO).cast("bigint"))
    seconds = (nanos.cast("decimal(20,0)") / F.lit(10**9)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def campaign_id(platform: str, name: Column) -> Column:
    """Surrogate key: 16 hex digits of a hash of platform and name as exported."""
    text = F.concat(F.lit(f"{platform}::"), F.coalesce(name, F.lit("nan")))
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def sanitise_revenue(revenue: Column) -> Column:
    """A negative revenue is no signal (NULL); zero is a real outcome and stays."""
    return F.when(revenue >= 0, revenue)


def clamp_negative(value: Column) -> Column:
    return F.when(value < 0, F.lit(0)).otherwise(value)
