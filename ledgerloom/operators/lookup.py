"""Code lists: small tables that many rows point at."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.session import settle


def lookup_join(df: DataFrame, lookup: DataFrame, code: str) -> DataFrame:
    """Attach the description of a code; null where the code is unknown.

    A few codes cover all rows. The list is settled, so the planner knows its bytes and broadcasts it if they are
    few; otherwise the runtime splits the rows of a hot code, which a left join allows.
    """
    return df.join(settle(lookup, "code-list"), code, "left")
