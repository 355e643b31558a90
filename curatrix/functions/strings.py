"""Strings of the contracts: timestamps, paths, pointers, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of the contracts.
UTC_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"
SCHEMA_PATH = r"^(?!/)(?!.*\\)(?!.*:)(?!.*(?:^|/)\.\.(?:/|$)).+$"
SHA256 = r"^[a-f0-9]{64}$"
MACHINE_PATH = r"^([/~]|[A-Za-z]:[\\/])"
#: Suffixes of image files.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff")


def _to_second(stamp: Column) -> Column:
    return F.try_to_timestamp(F.concat(F.substring(stamp, 1, 19), F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssX"))


def is_utc_timestamp(stamp: Column) -> Column:
    """RFC 3339 with Z, any number of fraction digits, a real date and time without leap seconds."""
    return F.coalesce(F.rlike(stamp, F.lit(UTC_TIMESTAMP)) & _to_second(stamp).isNotNull(), F.lit(False))


def time_key(stamp: Column) -> Column:
    """A struct that orders valid timestamps exactly, however long their fractions: the part up to the second,
    then the fraction's digits without trailing zeros, which order as strings."""
    fraction = F.rtrim(F.regexp_extract(stamp, r"\.(\d+)Z$", 1), F.lit("0"))
    return F.struct(F.substring(stamp, 1, 19).alias("second"), fraction.alias("fraction"))


def out_of_order(earlier: Column, later: Column) -> Column:
    """Both are valid and the later one is before the earlier one; equal times are in order."""
    valid = is_utc_timestamp(earlier) & is_utc_timestamp(later)
    return F.when(valid, time_key(later) < time_key(earlier)).otherwise(F.lit(False))


def is_clean_path(path: Column) -> Column:
    """Relative, with forward slashes only, no drive, NUL, empty, ``.`` or ``..`` segment."""
    bad_sign = F.rlike(path, F.lit(r"[\\:\x00]"))
    bad_part = F.exists(F.split(path, "/"), lambda part: part.isin("", ".", ".."))
    return F.coalesce(~bad_sign & ~bad_part, F.lit(False))


def pointer_escape(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def is_machine_path(text: Column) -> Column:
    """A configuration value that holds on one machine only."""
    return F.rlike(text, F.lit(MACHINE_PATH))


def sha256_mod(digest: Column, n: int) -> Column:
    """The integer that a hexadecimal digest spells, modulo ``n``."""
    digits = F.transform(F.split(digest, ""), lambda c: F.conv(c, 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: (a * 16 + F.coalesce(d, F.lit(0))) % n)


def suffix_of(path: Column) -> Column:
    """The last suffix of the file name in lower case, with its dot; empty for none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def numbered(prefix: str, digits: int, number: Column) -> Column:
    """``prefix`` and the zero-filled number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{digits}d", number)


def stable_order_key(scope: str, seed: int, value: Column) -> Column:
    """A pseudo-random order of values that depends on scope and seed alone."""
    return F.sha2(F.concat(F.lit(f"{scope}:{seed}:"), value), 256)
