"""Date encoded in a daily file name, as a column (so a file listing stays a DataFrame)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_filename(name: Column) -> Column:
    """Date from characters 5-8, 10-11 and 13-14 of ``ais-YYYY-MM-DD.csv.zst``.

    Only those positions matter: the prefix and suffix are not checked. Anything
    that does not form a real date (short names, letters, 2024-02-30) is null.
    """
    year = F.substring(name, 5, 4)
    month = F.substring(name, 10, 2)
    day = F.substring(name, 13, 2)
    digits = F.concat(year, month, day)
    return F.when(digits.rlike("^[0-9]{8}$") & (year != "0000"),
                  F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))
