"""Bounded samples that do not depend on how rows are stored or dealt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_share(df: DataFrame, hashed: Column, rows: int, wanted: int) -> DataFrame:
    """Rows whose hash lies in the share of all hashes that holds about four times ``wanted``.

    ``rows`` is the number of rows of ``df``. Of few rows all are kept. A limit that follows so
    gets a bounded number of rows in total, not as many as it asks for from every task.
    """
    bound = int(min(1.0, 4 * wanted / max(rows, 1)) * (1 << 31))
    return df.where(F.shiftrightunsigned(hashed, 33) < bound)
