"""Parsing, hashing and JSON helpers as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of the three personal identifiers.
SSN = r"\d{3}-\d{2}-\d{4}"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"\(\d{3}\) \d{3}-\d{4}"

PATTERNS = {"ssn": SSN, "email": EMAIL, "phone": PHONE}


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse(value: Column | str, kind: str) -> Column:
    """Typed value, or null where the text does not parse (it never fails the job)."""
    return F.trim(col_of(value)).try_cast(kind)


def parse_date(value: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(F.trim(col_of(value)), fmt)


def is_kind(value: Column | str, kind: str) -> Column:
    """Whole-value match with one of the identifier shapes."""
    return col_of(value).rlike(f"^{PATTERNS[kind]}$")


def initial(value: Column | str) -> Column:
    return F.substring(col_of(value), 1, 1)


def json_field(value: Column | str, path: str, kind: str | None = None) -> Column:
    """One field of a JSON text, typed if asked; bad JSON or a bad value gives null."""
    field = F.get_json_object(col_of(value), path)
    return field if kind is None else field.try_cast(kind)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp without time zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col_of(ts))
    return F.floor(micros / 1_000_000).cast("long")


def map_of(keys: Column, values: Column) -> Column:
    return F.map_from_entries(F.arrays_zip(keys, values))


def attribute_hash(cols: Sequence[str]) -> Column:
    """Hash of the listed attributes; JSON keeps nulls and column borders apart."""
    options = {"ignoreNullFields": "false"}
    return F.sha2(F.to_json(F.struct(*cols), options), 256)


def row_text(cols: Sequence[str]) -> Column:
    """The values as one text that keeps nulls, places and borders apart: length, colon, value, or a tilde for null."""
    text = [F.col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in text]
    return F.concat(*parts)


def row_checksum(cols: Sequence[str]) -> Column:
    """60 bits of a hash of the row's values; a value moved to another column changes it."""
    return F.conv(F.substring(F.md5(row_text(cols)), 1, 15), 16, 10).cast("long")


def file_checksum(cols: Sequence[str]) -> Column:
    """Aggregate over a file's rows that does not depend on their order.

    The sum of row hashes tells repeated rows apart, which a plain xor would cancel.
    """
    total = F.sum(row_checksum(cols).cast("decimal(38,0)"))
    return F.concat_ws(":", F.count("*"), F.coalesce(total, F.lit(0).cast("decimal(38,0)")))
