"""Text cleaning, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value token of the historical files, what may stand in
# and around a number, and plain dates.
MISSING_TOKEN = "-11111"
AROUND_NUMBERS = "$,% \t\r\n"
IN_NUMBERS = "0123456789.+-eE"
DATE = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
DIGITS = "0123456789"


def to_number(c: Column) -> Column:
    """Text to double: ``$``, ``,``, ``%`` and blanks go; what is no plain number is
    null, also words and suffixed numbers that a cast would take."""
    bare = F.translate(c, AROUND_NUMBERS, "")
    return F.when(F.translate(bare, IN_NUMBERS, "") == "", bare.try_cast("double"))


def to_date(c: Column) -> Column:
    """Text to date for year-month-day text with ``-`` or ``/``; else null."""
    bare = F.trim(c)
    return F.when(bare.rlike(DATE), F.translate(bare, "/", "-").try_cast("date"))


def sentinel_null(c: Column, token: str = MISSING_TOKEN) -> Column:
    """Null where the text contains the missing-value token."""
    return F.when(~c.contains(token), c)


def title_case(c: Column) -> Column:
    """Capitalise every word of letters and digits of any script. A hyphen starts a new
    word, an apostrophe inside a word does not."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{M}\p{N}]+(?:['’][\p{L}\p{M}\p{N}]+)*|[^\p{L}\p{M}\p{N}]+)"), F.lit(1))
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))),
        "",
    )


def pad_code(c: Column, width: int, pad: str = "0") -> Column:
    """Left-pad a code; a longer one is kept whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, pad)).otherwise(c)


def part(c: Column, sep: str, n: int) -> Column:
    """The n-th (from 1) piece of a delimited text, null past the end."""
    return F.get(F.split(c, sep), n - 1)


def drop_chars(c: Column, chars: str) -> Column:
    """Remove every one of the given characters."""
    return F.translate(c, chars, "")


def expand_year2(c: Column, pivot: int = 70) -> Column:
    """Two-digit year to four digits; below the pivot is 20xx."""
    y = c.try_cast("int")
    return F.when(y < pivot, y + 2000).otherwise(y + 1900)


def display_name(name: Column, fallback: Column) -> Column:
    """The name, or the fallback where the name is blank; a null name stays null."""
    return F.when(F.trim(name) == "", F.trim(fallback)).otherwise(F.trim(name))


def norm_code(c: Column) -> Column:
    """Code text such as ``' 2.0 '`` to an int; ``x``, other text and numbers beyond an
    int to null."""
    return F.round(to_number(c)).try_cast("int")


def whole_number(c: Column, type: str = "int") -> Column:
    """Text to a whole number; null for a fraction and beyond the type."""
    number = to_number(c)
    return F.when(number == F.rint(number), number.try_cast(type))


def concat_code(*cols: Column, sep: str = "") -> Column:
    """Composite code; null when a piece is null."""
    pieces = [c for pair in ((F.lit(sep), x) for x in cols) for c in pair][1:]
    return F.concat(*(pieces if sep else cols))


def fold_key(c: Column) -> Column:
    """Key in lower case without outer blanks."""
    return F.lower(F.trim(c))


def _digits(c: Column, n: int) -> Column:
    """The number in a text of exactly n digits, else null."""
    return F.when((F.length(c) == n) & (F.translate(c, DIGITS, "") == ""), c.try_cast("int"))


def year_from_name(file_name: Column) -> Column:
    """Data year of a yearly file, from its name: the second item between ``_``, four
    leading digits, or two digits after ``ret`` or in front. Plain string functions,
    as this runs for every row read."""
    lone = F.translate(F.substring(file_name, 3, 1), DIGITS, "") != ""
    four = [_digits(F.split_part(file_name, F.lit("_"), F.lit(2)), 4), _digits(F.substring(file_name, 1, 4), 4)]
    two = [F.when(file_name.startswith("ret"), _digits(F.substring(file_name, 4, 2), 2)),
           F.when(lone, _digits(F.substring(file_name, 1, 2), 2))]
    return F.coalesce(*four, *[expand_year2(c) for c in two])
