"""Column expressions that clean dirty text, dates, numbers, flags and lists.

All of them stay inside the JVM and none raises on bad input: what cannot be
read becomes null, also with ANSI mode on.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Every character that counts as blank at the edges of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PLAIN_EDGES = r"^ *[!-~](.*[!-~])? *$"
DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
DAY_AND_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
OFFSET_AT_END = r"(Z|[+-]\d{2}:?\d{2})$"
NO_SECONDS = r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^[+-]?[0-9]+$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"


def trim_blanks(value: Column) -> Column:
    """Text without any kind of blank at its two ends.

    Trimming a set of characters is slow, so texts that are seen to have nothing
    but spaces around them, which are nearly all, take the quick way.
    """
    text = value.cast("string")
    return F.when(text.rlike(PLAIN_EDGES), F.trim(text)).otherwise(F.trim(text, F.lit(BLANKS)))


def clean_text(value: Column) -> Column:
    """Text, trimmed and in lower case. Null stays null and empty stays empty."""
    return F.lower(trim_blanks(value))


def clean_date(value: Column) -> Column:
    """Calendar day of an ISO day or timestamp; an offset is resolved to the UTC day."""
    text = trim_blanks(value)
    stamp = F.regexp_replace(text, NO_SECONDS, "$1:00$2")
    utc_day = F.to_date(F.to_utc_timestamp(stamp.try_cast("timestamp"), F.current_timezone()))
    wall_day = F.to_date(stamp.try_cast("timestamp_ntz"))
    return F.when(text.rlike(DAY), text.try_cast("date")).when(
        text.rlike(DAY_AND_TIME), F.when(text.rlike(OFFSET_AT_END), utc_day).otherwise(wall_day)
    )


def clean_number(value: Column, to: str = "double") -> Column:
    """Number in plain decimal or exponent notation, everything else null.

    ``to="bigint"`` rounds a fraction half to even, as a database does when it
    stores a double in an integer column.
    """
    text = trim_blanks(value)
    number = F.when(text.rlike(NUMBER) | text.rlike(INFINITE), text.try_cast("double"))
    if to == "double":
        return number
    # A whole number need not go through a double, which holds 53 bits.
    return F.when(text.rlike(WHOLE), text.try_cast(to)).otherwise(F.rint(number).try_cast(to))


def first_of_list(items: Column) -> Column:
    """First element of a list, null for an empty one."""
    return F.get(items, F.lit(0))


def first_of_json(text: Column) -> Column:
    """Like ``first_of_list`` for a text that holds either a JSON list or a bare scalar."""
    is_list = F.ltrim(text).startswith("[")
    return F.when(is_list, F.get(F.from_json(text, "array<string>"), F.lit(0))).otherwise(text)


def join_list(items: Column, separator: str = ",") -> Column:
    """List as delimited text. A null element is written as ``None``; a null list stays null."""
    return F.array_join(items.cast("array<string>"), separator, "None")


def field_of_each(items: Column, field: str) -> Column:
    """One field of every struct in a list."""
    return F.transform(items, lambda item: item.getField(field))


def split_list(text: Column, separator: str = ",") -> Column:
    """Delimited text as a list, inner and trailing empties kept."""
    return F.split(text, rf"\Q{separator}\E", -1)


def to_flag(value: Column, true_values: Iterable[str]) -> Column:
    """True for the listed words, false for any other, null for null."""
    return clean_text(value).isin(sorted(true_values))


def parse_records(text: Column, record_ddl: str) -> Column:
    """JSON list of objects as a list of structs."""
    return F.from_json(text, f"array<{record_ddl}>")


def parse_map(text: Column, strict: bool = False) -> Column:
    """JSON object with free keys as a map of texts. With ``strict`` a text that is not JSON raises; else it gives null."""
    return F.from_json(text, "map<string,string>", {"mode": "FAILFAST"} if strict else {})
