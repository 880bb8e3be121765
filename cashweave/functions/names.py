"""Header and merchant name keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


# What lies between the words of a header; in both forms of its key.
_HEADER_GAP = "[^a-z0-9]+"


def normalise_header(name: str | None) -> str:
    """Lower case; every run of other characters becomes one blank."""
    return re.sub(_HEADER_GAP, " ", (name or "").lower()).strip(" ")


def header_key(name: Column) -> Column:
    """:func:`normalise_header` as a Column expression."""
    return F.trim(F.regexp_replace(F.lower(name), _HEADER_GAP, " "))


def merchant_norm(name: Column) -> Column:
    """Lower case with white space collapsed."""
    return F.lower(F.regexp_replace(name, r"\s+", " "))


def merchant_key(name: Column) -> Column:
    """Surrogate id. A hash of the name, so a recomputed task gives it again."""
    return F.sha2(name, 256)
