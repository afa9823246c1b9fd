"""Stable identities: canonical JSON and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _escaped(char: Column) -> Column:
    code = F.ascii(char)
    offset = code - F.lit(0x10000)

    def unit(number: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(number)), 4, "0"))

    pair = F.concat(
        unit(F.lit(0xD800) + F.shiftright(offset, 10)),
        unit(F.lit(0xDC00) + offset.bitwiseAND(F.lit(0x3FF))),
    )
    return F.when(code < 127, char).when(code < 0x10000, unit(code)).otherwise(pair)


def ascii_json(text: Column) -> Column:
    """JSON text with every character outside printable ASCII written as ``\\uXXXX``."""
    escaped = F.array_join(F.transform(F.split(text, ""), _escaped), "")
    return F.when(text.rlike(r"[^\x00-\x7e]"), escaped).otherwise(text)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON object with sorted names, nulls kept, in ASCII."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return ascii_json(F.to_json(ordered, {"ignoreNullFields": "false"}))


def sha256_hex(text: Column) -> Column:
    """SHA-256 of a text in hexadecimal."""
    return F.sha2(text, 256)


def short_digest(text: Column, length: int = 16) -> Column:
    """Leading hexadecimal digits of the SHA-256 of a text."""
    return F.substring(F.sha2(text, 256), 1, length)


def execution_name(created_at: Column, digest: Column) -> Column:
    """``execution-<stamp>-<digest>`` from a UTC ISO text and an item digest."""
    stamp = F.regexp_replace(F.split_part(created_at, F.lit("+"), F.lit(1)), "[-:.]", "")
    return F.concat(F.lit("execution-"), stamp, F.lit("Z-"), F.substring(digest, 1, 10))
