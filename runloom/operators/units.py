"""Processing units: runs grouped into the samples that are processed as one."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.identity import canonical_json, sha256_hex
from ..functions.values import EXACT_SUM, blank_to_null, lenient_int, lenient_int_via_float
from ..ordering import (
    ORD,
    PACK_LIMIT,
    group_sizes,
    heavy_keys,
    pack_ordered,
    set_digest_aggs,
    set_digest_limbs,
    set_digest_text,
)
from ..violations import violation_rows

# Columns that hold the species, and the list-valued fields of a unit.
TAXID_COLUMNS = ("TaxID", "species_taxid", "taxid")
SPECIES_COLUMNS = ("ScientificName", "scientific_name")
MEMBER_COLUMNS = {
    "run_accessions": ("Run",),
    "experiment_accessions": ("Experiment",),
    "sra_sample_accessions": ("SRA Sample", "Sample"),
    "biosample_accessions": ("BioSample",),
    "library_strategy": ("LibraryStrategy",),
    "library_layout": ("LibraryLayout",),
    "platform": ("Platform",),
}
ACCESSION_KINDS = tuple(kind for kind in MEMBER_COLUMNS if kind.endswith("_accessions"))


@dataclass(frozen=True)
class Units:
    """Units in normalized form.

    ``table`` has one row of scalars per unit, ``members`` one row per distinct value
    of a list field with the order of its first appearance, ``run_sizes`` one row per
    run. Lists are kept as rows because one unit may own any share of the catalog;
    ``packed`` builds arrays for the groups that fit.
    """

    table: DataFrame
    members: DataFrame
    run_sizes: DataFrame
    violations: DataFrame

    def packed(self, limit: int = PACK_LIMIT) -> DataFrame:
        """``(unit_id, kind, chunk, n_chunks, values)``; one chunk unless a group is hot."""
        return pack_ordered(self.members, ["unit_id", "kind"], "value", limit=limit).select(
            "unit_id", "kind", "chunk", "n_chunks", "values"
        )


def _key(df: DataFrame, group_column: str) -> Column:
    return F.coalesce(blank_to_null(F.col(f"`{group_column}`")), F.col("Run").cast("string"))


def _present(df: DataFrame, names) -> list[str]:
    return [name for name in names if name in df.columns]


def _lowest(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.least(*columns)


def _highest(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def first_filled(order: str, *columns: str) -> Column:
    """Aggregate: first non-empty value of the first column, else of the next one.

    All rows are looked at for one column before the next column is tried.
    """
    firsts = []
    for name in columns:
        value = blank_to_null(F.col(f"`{name}`"))
        firsts.append(F.min_by(value, F.when(value.isNotNull(), F.col(order))))
    return F.coalesce(*firsts)


def summarize_units(df: DataFrame, group_column: str) -> DataFrame:
    """Scalars per unit, with the bounds that reveal contradicting species.

    Sizes are added as exact decimals, so the total does not depend on the order in
    which tasks finish.
    """
    def number(name: str) -> Column:
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")

    bases = F.coalesce(lenient_int_via_float(number("bases")), F.lit(0))
    size_mb = F.coalesce(number("size_MB").cast("string").try_cast(EXACT_SUM), F.lit(0))
    taxids = _present(df, TAXID_COLUMNS)
    species = _present(df, SPECIES_COLUMNS)
    aggs = [F.sum(bases).alias("total_bases"), F.sum(size_mb).alias("_size_mb")]
    for name in taxids:
        aggs += [F.min(lenient_int(F.col(name))).alias(f"lo {name}"), F.max(lenient_int(F.col(name))).alias(f"hi {name}")]
    for name in species:
        aggs += [F.min(blank_to_null(F.col(name))).alias(f"lo {name}"), F.max(blank_to_null(F.col(name))).alias(f"hi {name}")]
    bad = [blank_to_null(F.col(n)).isNotNull() & lenient_int(F.col(n)).isNull() for n in taxids]
    aggs.append(F.bool_or(reduce(lambda a, b: a | b, bad, F.lit(False))).alias("_bad_taxid"))
    grouped = df.groupBy(_key(df, group_column).alias("unit_id")).agg(*aggs, F.min(ORD).alias(ORD))

    def bound(names: list[str], side: str, pick, kind: str) -> Column:
        columns = [F.col(f"`{side} {n}`") for n in names]
        return pick(columns) if columns else F.lit(None).cast(kind)

    lo_tax, hi_tax = bound(taxids, "lo", _lowest, "bigint"), bound(taxids, "hi", _highest, "bigint")
    lo_name, hi_name = bound(species, "lo", _lowest, "string"), bound(species, "hi", _highest, "string")
    return grouped.select(
        "unit_id",
        lo_name.alias("scientific_name"),
        lo_tax.alias("taxid"),
        "total_bases",
        (F.col("_size_mb").cast("double") / 1000).alias("total_size_gb"),
        F.coalesce(lo_tax != hi_tax, F.lit(False)).alias("_many_taxids"),
        F.coalesce(lo_name != hi_name, F.lit(False)).alias("_many_names"),
        "_bad_taxid",
        F.concat_ws("..", lo_tax, hi_tax).alias("_taxid_range"),
        F.concat_ws("..", lo_name, hi_name).alias("_name_range"),
        ORD,
    )


def species_conflicts(summary: DataFrame) -> DataFrame:
    """Units that span species, or whose taxonomy id is not a number."""
    wrong = summary.filter(F.col("_many_taxids") | F.col("_many_names") | F.col("_bad_taxid"))
    return violation_rows(
        wrong,
        "processing_units",
        F.col("unit_id"),
        F.concat(F.lit("taxids "), F.col("_taxid_range"), F.lit(", names "), F.col("_name_range")),
    )


def unit_members(df: DataFrame, group_column: str, *, unique_runs: bool = False) -> DataFrame:
    """Distinct non-empty list values per unit with the order of first appearance.

    The rows are grouped by unit, field *and* value, so a unit with a large share of
    the catalog is spread over all tasks. In a catalog of ``unique_runs`` every run is one
    row, so runs are not grouped.
    """
    pairs, names = [], []
    for kind, candidates in MEMBER_COLUMNS.items():
        present = _present(df, candidates)
        if present:
            pairs.append(
                F.struct(F.lit(kind).alias("kind"), F.col(f"`{present[0]}`").cast("string").alias("value"))
            )
            names.append(kind)
    shared = [p for p, kind in zip(pairs, names) if not (unique_runs and kind == "run_accessions")]
    own = [p for p, kind in zip(pairs, names) if unique_runs and kind == "run_accessions"]

    def listed(chosen: list[Column]) -> DataFrame:
        return df.select(
            _key(df, group_column).alias("unit_id"), ORD, F.explode(F.array(*chosen)).alias("m")
        ).filter("m.value IS NOT NULL AND m.value <> ''")

    parts = [_first_members(listed(shared))] if shared else []
    parts += [listed(own).select("unit_id", "m.kind", "m.value", ORD)] if own else []
    return reduce(DataFrame.unionByName, parts)


def _first_members(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("unit_id", F.col("m.kind").alias("kind"), F.col("m.value").alias("value")).agg(
        F.min(ORD).alias(ORD)
    )


def packed_members(df: DataFrame, group_column: str, *, unique_runs: bool = False, limit: int = PACK_LIMIT) -> DataFrame:
    """``unit_members`` packed as ``Units.packed`` does, with the rows of a unit brought together once.

    A unit of at most ``limit`` rows is one list of its rows, sorted once, from which the distinct
    values of each field are taken in order. Larger units are packed by way of their members.
    """
    kinds = {kind: found[0] for kind, names in MEMBER_COLUMNS.items() if (found := _present(df, names))}
    unit, ordered = _key(df, group_column), df.schema[ORD].dataType
    order = {f"_at{i}": F.col(ORD)[name] for i, name in enumerate(ordered.fieldNames())} if isinstance(ordered, StructType) else {"_at0": F.col(ORD)}
    rows = df.select(
        unit.alias("unit_id"), *[c.alias(n) for n, c in order.items()], *[F.col(f"`{c}`").cast("string").alias(kind) for kind, c in kinds.items()]
    )
    heavy = heavy_keys(rows, "unit_id", limit)
    light = rows if heavy is None else rows.join(F.broadcast(heavy), "unit_id", "left_anti")
    # The order is kept flat: the engine makes the order of an inner struct anew for each comparison.
    items = F.array_sort(F.collect_list(F.struct(*order, *kinds))).alias("_items")
    grouped = light.repartition("unit_id").groupBy("unit_id").agg(items)

    def at(row: Column) -> list[Column]:
        return [row[c] for c in order]

    def tied(rows: Column) -> Column:
        same = lambda r, i: reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(at(r), at(rows[i - 1]))])
        return F.exists(F.transform(rows, lambda r, i: (i > 0) & same(r, i)), lambda t: t)

    def listed(kind: str) -> Column:
        # Values of rows that are equal in order follow each other by themselves.
        by_value = F.array_sort(F.transform("_items", lambda r: F.struct(*at(r), r[kind])))[kind]
        values = F.when(F.col("_tied"), by_value).otherwise(F.col("_items")[kind])
        filled = F.filter(values, lambda v: v.isNotNull() & (v != ""))
        return F.struct(F.lit(kind).alias("kind"), F.lit(0).alias("chunk"), F.lit(1).alias("n_chunks"), F.array_distinct(filled).alias("values"))

    lists = grouped.withColumn("_tied", tied(F.col("_items"))).select("unit_id", F.inline(F.array(*map(listed, kinds))))
    packed = lists.filter(F.size("values") > 0)
    if heavy is None:
        return packed
    members = unit_members(df.join(F.broadcast(heavy), unit == heavy["unit_id"], "left_semi"), group_column, unique_runs=unique_runs)
    return packed.unionByName(pack_ordered(members, ["unit_id", "kind"], "value", limit=limit).select(*packed.columns))


def unit_run_sizes(df: DataFrame, group_column: str, *, unique_runs: bool = False) -> DataFrame:
    """Size per unit and run; the last row of a run wins, if there can be several."""
    size_mb = F.col("size_MB") if "size_MB" in df.columns else F.lit(None)
    size = F.coalesce(F.trim(size_mb.cast("string")).try_cast("double"), F.lit(0.0)) / 1000
    named = df.filter(F.coalesce(F.col("Run").cast("string"), F.lit("")) != "")
    keys = [_key(df, group_column).alias("unit_id"), F.col("Run").cast("string").alias("run")]
    if unique_runs:
        return named.select(*keys, size.alias("size_gb"))
    return named.groupBy(*keys).agg(F.max_by(size, F.col(ORD)).alias("size_gb"))


def group_units(df: DataFrame, group_column: str, *, unique_runs: bool = False) -> Units:
    """Group a run table into units; see ``Units`` for the shape of the result.

    ``unique_runs`` says that the table has one row per run, as merged catalogs do.
    """
    summary = summarize_units(df, group_column)
    hidden = [c for c in summary.columns if c.startswith("_") and c != ORD]
    return Units(
        table=summary.drop(*hidden),
        members=unit_members(df, group_column, unique_runs=unique_runs),
        run_sizes=unit_run_sizes(df, group_column, unique_runs=unique_runs),
        violations=species_conflicts(summary),
    )


def accession_sets(members: DataFrame) -> DataFrame:
    """Per unit and accession field a list of one text that identifies the whole set.

    The text holds the number of distinct accessions and the XOR of their digests, whatever
    the size of the unit, so its identity covers every accession, does not depend on any
    limit, and is one aggregate that combines before the shuffle. No accessions: no text.
    """
    limbs = {f"_limb{i}": limb for i, limb in enumerate(set_digest_limbs(F.col("value")))}
    kinds = members.filter(F.col("kind").isin(*ACCESSION_KINDS)).select("unit_id", "kind", "value", *[c.alias(n) for n, c in limbs.items()])

    def of_kind(kind: str, name: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(name))

    summed = kinds.groupBy("unit_id").agg(
        *[a for kind in ACCESSION_KINDS for a in set_digest_aggs([of_kind(kind, limb) for limb in limbs], f"_{kind}_")],
        *[F.count(of_kind(kind, "value")).alias(f"_{kind}_n") for kind in ACCESSION_KINDS],
    )

    def text(kind: str) -> Column:
        n = F.col(f"_{kind}_n")
        listed = F.array(set_digest_text(f"_{kind}_", n))
        return F.when(n > 0, listed).otherwise(F.array().cast("array<string>")).alias(kind)

    return summed.select("unit_id", *[text(kind) for kind in ACCESSION_KINDS])


def unit_fingerprints(
    units: DataFrame,
    accessions: DataFrame,
    *,
    group_by: str,
    processor_identity: str,
    fastq_identity: Column | None = None,
    pins: DataFrame | None = None,
    descriptions: DataFrame | None = None,
) -> DataFrame:
    """Identity of the work a unit stands for: SHA-256 of its canonical JSON.

    ``pins`` is ``(taxid, accession)``; ``descriptions`` is ``(unit_id, profile,
    sha256)``. Both are optional left joins that the optimizer plans by size.
    """
    joined = units.join(accessions, "unit_id", "left")
    if pins is not None:
        joined = joined.join(pins.select("taxid", F.col("accession").alias("genome_pin")), "taxid", "left")
    else:
        joined = joined.withColumn("genome_pin", F.lit(None).cast("string"))
    if descriptions is not None:
        identity = descriptions.select(
            "unit_id", F.struct("profile", "sha256").alias("description_identity")
        )
        joined = joined.join(identity, "unit_id", "left")
    else:
        joined = joined.withColumn(
            "description_identity", F.lit(None).cast("struct<profile:string,sha256:string>")
        )
    lists = {
        kind: F.coalesce(F.col(kind), F.array().cast("array<string>")) for kind in ACCESSION_KINDS
    }
    text = canonical_json(
        group_by=F.lit(group_by),
        unit_id=F.col("unit_id"),
        taxid=F.col("taxid"),
        genome_pin=F.col("genome_pin"),
        processor_identity=F.lit(processor_identity),
        description_identity=F.col("description_identity"),
        fastq_identity=F.lit(None).cast("string") if fastq_identity is None else fastq_identity,
        **lists,
    )
    return joined.withColumn("fingerprint", sha256_hex(text))
