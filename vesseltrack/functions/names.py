"""Identity helpers: vessel-name normalisation and MMSI validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(name: Column) -> Column:
    """Upper-case, trim and drop everything but A-Z and 0-9.

    Two names without any Latin letter or digit both become '' and so compare
    equal; a null stays null and never compares equal.
    """
    return F.regexp_replace(F.upper(F.trim(name)), "[^A-Z0-9]", "")


def valid_mmsi(mmsi: Column) -> Column:
    """A ship identity: 9 characters whose first is '2'..'7' (string test, digits not checked)."""
    first = F.substring(mmsi, 1, 1)
    return (F.length(mmsi) == 9) & first.between("2", "7")
