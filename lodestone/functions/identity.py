"""Identity of records: content hashes and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash16(text: Column) -> Column:
    """The first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def checksum(content: Column, codes: Column) -> Column:
    """SHA-256 of the content and all code blocks, one below the other; nulls are empty."""
    parts = F.transform(F.concat(F.array(content), F.coalesce(codes, F.array().cast("array<string>"))), lambda x: F.coalesce(x, F.lit("")))
    return F.sha2(F.array_join(parts, "\n"), 256)


def derived_id(given: Column, code: Column, prefix: str = "vex_") -> Column:
    """The given id, or one made of the code's hash."""
    return F.when(F.coalesce(given, F.lit("")) == "", F.concat(F.lit(prefix), hash16(code))).otherwise(given)
