"""Column expressions for sheet names and untyped sheet cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.schemas import TOWERS, UTILITIES, lookup

# Cell texts that spreadsheet readers commonly treat as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
SHEET_NAME = r"^T .* .* [rR]eadings\.xlsx?$"

_DAY_FIRST = r"^(\d{1,2})-(\d{1,2})-(\d{4}) "
_YEAR_FIRST_CLOCK = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}(:\d{1,2})?$"
_DAY_FIRST_12_HOURS = (
    r"(?i)^\d{1,2}-\d{1,2}-(?!0000)\d{4} (0?[1-9]|1[0-2]):\d{1,2}(:\d{1,2})? [ap]m$"
)
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"
_EXPORTED_NUMBER = r"^-?(0|[1-9]\d*)(\.\d*)?$"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (F.trim removes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def single_spaced(text: Column) -> Column:
    """Strip, and make every inner stretch of white space one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def present(cell: Column) -> Column:
    """Cell text, or NULL for the texts that mean 'missing'."""
    return F.when(~cell.isin(MISSING_TEXTS), cell)


# -- file names ------------------------------------------------------------------------


def name_words(source_file: Column) -> Column:
    """Words before ' readings'."""
    return F.split(single_spaced(F.substring_index(source_file, " readings", 1)), " ")


def tower_letter(words: Column) -> Column:
    return F.upper(F.get(words, F.lit(1)))


def tower_name(letter: Column) -> Column:
    return lookup(TOWERS, letter)


def utility_type(words: Column) -> Column:
    by_lower_case = {word.lower(): utility for word, utility in UTILITIES.items()}
    return lookup(by_lower_case, F.lower(F.get(words, F.lit(2))))


# -- flat ids --------------------------------------------------------------------------


def raw_flat_id(header: Column) -> Column:
    """Trimmed text; what a sheet writes for a number loses its fraction (101.7 -> 101).

    The cut is made in the text, so ids of any length stay distinct. Texts that no number is
    written as (007, +5) are ids as they stand.
    """
    text = strip(header)
    whole = F.regexp_replace(F.regexp_replace(text, r"\..*$", ""), "^-0$", "0")
    return F.when(text.rlike(_EXPORTED_NUMBER), whole).otherwise(text)


def normalize_flat_id(header: Column, letter: Column) -> Column:
    """As raw_flat_id, without a leading tower letter and the spaces after it."""
    text = raw_flat_id(header)
    without_letter = F.regexp_replace(F.substring(text, 2, 2**31 - 1), r"^\s+", "")
    return F.when(F.upper(text).startswith(letter), without_letter).otherwise(text)


# -- reading times ---------------------------------------------------------------------


# Casts instead of format attempts: a failed attempt raises inside the parser, and
# to_timestamp would go through the session time zone.


def _clock_time(year_first: Column) -> Column:
    """Year-first 24-hour text as a zone-less timestamp, NULL if it is none."""
    return F.when(year_first.rlike(_YEAR_FIRST_CLOCK), year_first.try_cast("timestamp_ntz"))


def parse_reading_time(cell: Column) -> Column:
    """Y-m-d or d-m-Y with H:M[:S], or d-m-Y with a 12-hour clock and AM/PM; else NULL."""
    text = single_spaced(cell)
    year_first = F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1 ")
    without_marker = F.regexp_replace(year_first, r"(?i) [ap]m$", "")
    since_noon_or_midnight = F.replace(without_marker, F.lit(" 12:"), F.lit(" 0:"))
    afternoon = F.when(F.lower(text).endswith("pm"), 12).otherwise(0)
    return F.when(
        text.rlike(_DAY_FIRST_12_HOURS),
        since_noon_or_midnight.try_cast("timestamp_ntz") + F.make_dt_interval(hours=afternoon),
    ).otherwise(_clock_time(year_first))


def parse_time_24h(cell: Column) -> Column:
    """The daily job's rule: d-m-Y only; an AM/PM suffix is dropped and means nothing."""
    text = single_spaced(F.regexp_replace(strip(cell), " (AM|PM|am|pm)$", ""))
    return F.when(
        text.rlike(_DAY_FIRST), _clock_time(F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1 "))
    )


# -- reading values --------------------------------------------------------------------


# Nearly every cell consists of these characters only; a cast decides on them alone. What
# else counts as a number (1_000, inf, nan) or does not (1d, 0x10) takes the longer way.


def _is_plain(cell: Column) -> Column:
    return cell.rlike(r"^[0-9.+\-eE]+$")


def _number_text(cell: Column) -> Column:
    return F.regexp_replace(strip(cell), r"(?<=\d)_(?=\d)", "")


def is_bad_number(cell: Column) -> Column:
    """A present cell that is not a number (this rejects its whole file)."""
    bad = F.when(_is_plain(cell), cell.try_cast("double").isNull()).otherwise(
        ~_number_text(cell).rlike(_NUMBER)
    )
    return F.coalesce(bad, F.lit(False))


def reading_value(cell: Column) -> Column:
    text = _number_text(cell)
    unusual = F.when(
        text.rlike(_NUMBER) & ~F.lower(text).endswith("nan"), text.try_cast("double")
    )
    return F.when(_is_plain(cell), cell.try_cast("double")).otherwise(unusual)
