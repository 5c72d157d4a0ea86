"""Column expressions: money, flags, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlark.sources.tables import ON_SALE_ABOVE_SIZE

# Separator of words: whatever is neither a letter nor a digit.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def cents(amount: str | Column) -> Column:
    """A money amount with two decimals as whole cents, safe to add up.

    Such an amount times 100 is a whole number up to floating-point noise, so the
    cheap ``rint`` gives the same as a decimal rounding.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(column * 100).cast("bigint")


def count_rows() -> Column:
    return F.count(F.lit(1))


def line_cents() -> Column:
    return cents("l_extendedprice")


def moment(text: str) -> Column:
    """A point on the clock of the tables, whatever time zone the session has."""
    return F.lit(text).cast("timestamp_ntz")


def on_sale() -> Column:
    return F.col("p_size") > ON_SALE_ABOVE_SIZE


def whole_average(column: str | Column) -> Column:
    """Average rounded half away from zero, then stored as a whole number."""
    return F.round(F.avg(column)).cast("bigint")


def or_zero(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def words(text: str | Column) -> Column:
    """Lower-case words of a text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(column), WORD_BREAK), lambda word: word != "")


def grams(text: str | Column, size: int = 3) -> Column:
    """Distinct lower-case character runs of a whole text, spaces included.

    The look-ahead captures the run while each match consumes one character, so
    one pass over the text yields all overlapping runs.
    """
    column = F.lower(F.col(text) if isinstance(text, str) else text)
    pattern = "(?s)(?=(.{%d}))." % size
    return F.array_distinct(F.regexp_extract_all(column, F.lit(pattern), F.lit(1)))


def query_grams(term: str, size: int = 3) -> list[str]:
    """The same runs for a search term given as a Python string."""
    low = term.lower()
    return sorted({low[i:i + size] for i in range(len(low) - size + 1)})


def prefix_end(prefix: str) -> str:
    """The smallest string above every string starting with ``prefix``."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)
