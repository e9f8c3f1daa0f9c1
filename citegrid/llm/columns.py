"""Column helpers of the training-data operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but space and \x09 to \x0D.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(column: str) -> Column:
    """Number of words, as long; null text has none."""
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
