"""Lenient conversions, path lookups and small value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GB = 1_000_000_000
EXACT_SUM = "decimal(28,9)"


def blank_to_null(value: Column) -> Column:
    """Treat the empty string as missing."""
    return F.nullif(value.cast("string"), F.lit(""))


def lenient_int(value: Column) -> Column:
    """Integer from text, null when it is not one."""
    return F.trim(value.cast("string")).try_cast("bigint")


def lenient_int_via_float(value: Column) -> Column:
    """Integer part of a number given as text, null when it is not a number."""
    return F.trim(value.cast("string")).try_cast("double").try_cast("bigint")


def lenient_float(value: Column) -> Column:
    """Number from text, null when it is not one."""
    return F.trim(value.cast("string")).try_cast("double")


def bytes_to_gb(value: Column) -> Column:
    """Decimal gigabytes from a byte count."""
    return lenient_int(value) / F.lit(GB)


def gb_to_bytes(value: Column) -> Column:
    """Byte count from decimal gigabytes."""
    return F.bround(value.cast("double") * F.lit(float(GB)), 0).cast("bigint")


def truthy_number(*values: Column) -> Column:
    """First value that is neither null nor zero, else zero."""
    return F.coalesce(*[F.nullif(v, F.lit(0)) for v in values], F.lit(0))


def first_path(document: Column, *paths: str) -> Column:
    """First non-empty value among dotted paths of a JSON text."""
    return F.coalesce(
        *[F.nullif(F.get_json_object(document, f"$.{path}"), F.lit("")) for path in paths]
    )


def identifier_in(identifiers: Column, namespace: str) -> Column:
    """Value of the first identifier record in a namespace, ignoring case."""
    matches = F.filter(identifiers, lambda r: F.lower(r["namespace"]) == namespace.lower())
    return F.try_element_at(matches, F.lit(1))["value"]


def pubmed_ids(links: Column) -> Column:
    """Ids of the PubMed links among link records, in order."""
    pubmed = F.filter(
        links,
        lambda l: (F.lower(l["database"]) == "pubmed") & (F.coalesce(l["id"], F.lit("")) != ""),
    )
    return F.transform(pubmed, lambda l: l["id"])


def with_unit(value: Column, unit: Column) -> Column:
    """Value followed by its unit when it has one."""
    return F.when(F.coalesce(unit, F.lit("")) != "", F.concat_ws(" ", value, unit)).otherwise(value)


def fold_attributes(records: Column) -> Column:
    """Attribute records as ``MAP<name, ARRAY<value with unit>>``; repeats keep order.

    One record list belongs to one entity row, so the fold is a higher-order
    expression inside the row and needs no shuffle.
    """
    plain = F.transform(records, lambda r: F.struct(r["name"].alias("name"), r["value"].alias("value"), r["units"].alias("units")))
    records = F.coalesce(plain, F.array().cast("array<struct<name:string,value:string,units:string>>"))
    names = F.array_distinct(F.transform(records, lambda r: r["name"]))
    values = F.transform(
        names,
        lambda name: F.transform(
            F.filter(records, lambda r: r["name"] == name),
            lambda r: with_unit(r["value"], r["units"]),
        ),
    )
    return F.map_from_arrays(names, values)


def sorted_attribute_json(attributes: Column) -> Column:
    """JSON object with sorted names; one value is written as text, several as a list.

    The separators are a comma and a colon, each followed by one space.
    """
    def quoted(text: Column) -> Column:
        escaped = F.to_json(F.struct(text.alias("v")))
        return F.substring(escaped, F.lit(6), F.length(escaped) - F.lit(6))

    def listed(values: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]"))

    entries = F.transform(
        F.array_sort(F.map_keys(attributes)),
        lambda k: F.concat(
            quoted(k),
            F.lit(": "),
            F.when(
                F.size(F.element_at(attributes, k)) == 1,
                quoted(F.element_at(F.element_at(attributes, k), F.lit(1))),
            ).otherwise(listed(F.element_at(attributes, k))),
        ),
    )
    return F.when(
        attributes.isNull(), F.lit("{}")
    ).otherwise(F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")))


def submitter_text(name: Column, abbreviation: Column, center: Column) -> Column:
    """``name (abbreviation)``, the name alone, or the center when there is no name."""
    name, abbreviation = blank_to_null(name), blank_to_null(abbreviation)
    return F.when(
        name.isNotNull() & abbreviation.isNotNull() & (name != abbreviation),
        F.concat(name, F.lit(" ("), abbreviation, F.lit(")")),
    ).otherwise(F.coalesce(name, center))


def size_limit_gb(text: str) -> float | None:
    """Gigabytes meant by a size setting such as ``100G``; ``None`` means no limit."""
    cleaned = text.strip().lower()
    if cleaned in ("u", "unlimited"):
        return None
    # Decimal factors of the unit letters, relative to one gigabyte.
    factors = {"k": 1e-6, "m": 1e-3, "g": 1.0, "t": 1_000.0}
    number = cleaned.removesuffix("b").rstrip()
    unit = number[-1:] if number[-1:] in factors else ""
    digits = number.removesuffix(unit).rstrip()
    whole, _, fraction = digits.partition(".")
    if not whole.isdigit() or ("." in digits and not fraction.isdigit()):
        raise ValueError(f"size must look like 100G, 1.5T or unlimited: {text!r}")
    return float(digits) * factors.get(unit, 1e-9)


def utc_text(moment: Column) -> Column:
    """ISO text of a UTC timestamp with microseconds and offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
