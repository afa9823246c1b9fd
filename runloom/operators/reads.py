"""Read files: size limits, mate pairing, layouts and quality decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import is_read_file, mate_number, pair_key, url_file_name
from ..functions.text import safe_identifier
from ..functions.values import size_limit_gb
from ..ordering import PACK_LIMIT, pack_ordered
from ..violations import violation_rows

SINGLE, PAIRED, MIXED = "single", "paired", "mixed"


def oversized_runs(run_sizes: DataFrame, max_size: str) -> DataFrame:
    """Runs (``unit_id, run, size_gb``) above a size setting, as violation rows."""
    limit = size_limit_gb(max_size)
    above = F.lit(False) if limit is None else F.col("size_gb") > F.lit(limit)
    return violation_rows(
        run_sizes.filter(above),
        "prefetch_max_size",
        F.col("unit_id"),
        F.format_string("%s=%.3f GB", F.col("run"), F.col("size_gb")),
    )


def classify_read_files(urls: DataFrame) -> DataFrame:
    """Read files among ``(unit_id, url)`` with name, mate number and pair key."""
    named = urls.withColumn("name", url_file_name(F.col("url")))
    return (
        named.filter(is_read_file(F.col("name")))
        .withColumn("mate", mate_number(F.col("name")))
        .withColumn("pair_key", pair_key(F.col("name")))
    )


def pair_mates(files: DataFrame) -> DataFrame:
    """One row per unit and pair key with both mates and the copies seen of each.

    This is the pivot of the mate column written as conditional aggregates.
    """
    def mate(digit: str) -> Column:
        return F.when(F.col("mate") == digit, F.col("name"))

    return (
        files.filter(F.col("mate").isNotNull())
        .groupBy("unit_id", "pair_key")
        .agg(
            F.min(mate("1")).alias("read1"),
            F.min(mate("2")).alias("read2"),
            F.count(mate("1")).alias("n1"),
            F.count(mate("2")).alias("n2"),
        )
    )


def pairing_violations(pairs: DataFrame) -> DataFrame:
    """Duplicate mates and pairs that lack one mate."""
    wrong = pairs.filter("n1 <> 1 OR n2 <> 1")
    detail = F.concat(
        F.when((F.col("n1") > 1) | (F.col("n2") > 1), F.lit("duplicate mate for ")).otherwise(F.lit("incomplete pair ")),
        F.col("pair_key"),
    )
    return violation_rows(wrong, "pair_mates", F.col("unit_id"), detail)


def unit_layouts(files: DataFrame) -> DataFrame:
    """Layout per unit from the classified files."""
    seen = files.groupBy("unit_id").agg(
        F.bool_or(F.col("mate").isNotNull()).alias("_pairs"),
        F.bool_or(F.col("mate").isNull()).alias("_singles"),
        F.count(F.lit(1)).alias("n_files"),
    )
    return seen.select("unit_id", layout_of(F.col("_pairs"), F.col("_singles")).alias("layout"), "n_files")


def layout_of(has_pairs: Column, has_singles: Column) -> Column:
    """Layout name, null when there are no files at all."""
    return (
        F.when(has_pairs & has_singles, F.lit(MIXED))
        .when(has_pairs, F.lit(PAIRED))
        .when(has_singles, F.lit(SINGLE))
    )


def ordered_file_lists(files: DataFrame, limit: int = PACK_LIMIT) -> DataFrame:
    """File names per unit and role: mates by pair key, single files by name."""
    role = (
        F.when(F.col("mate") == "1", F.lit("read1")).when(F.col("mate") == "2", F.lit("read2")).otherwise(F.lit("single"))
    )
    ordered = files.select(
        "unit_id", role.alias("role"), F.coalesce("pair_key", "name").alias("ord"), "name"
    )
    return pack_ordered(ordered, ["unit_id", "role"], "name", "ord", limit).select(
        "unit_id", "role", "chunk", "n_chunks", F.col("values").alias("files")
    )


def run_layouts(run_files: DataFrame) -> DataFrame:
    """Roles present per run of ``(unit_id, run, run_pos, role, path)``; at most three."""
    return run_files.groupBy("unit_id", "run", "run_pos").agg(
        F.array_sort(F.collect_set("role")).alias("roles")
    )


def unit_layouts_from_runs(run_files: DataFrame) -> DataFrame:
    """Layout per unit from the files of its runs, with a reason when unusable."""
    def has(role: str) -> Column:
        return F.bool_or(F.col("role") == role)

    seen = run_files.groupBy("unit_id").agg(
        has("read1").alias("r1"), has("read2").alias("r2"), has("single").alias("s")
    )
    both = F.col("r1") & F.col("r2")
    return seen.select(
        "unit_id",
        layout_of(both, F.col("s")).alias("layout"),
        F.when(F.col("r1") != F.col("r2"), F.lit("one mate is missing"))
        .when(~both & ~F.col("s"), F.lit("no usable read files"))
        .alias("reason"),
    )


def merge_order(run_files: DataFrame, limit: int = PACK_LIMIT) -> DataFrame:
    """Paths to concatenate per unit and role, in the run order of the unit."""
    return pack_ordered(run_files, ["unit_id", "role"], "path", "run_pos", limit).select(
        "unit_id", "role", "chunk", "n_chunks", F.col("values").alias("paths")
    )


def layout_problem(layout: Column, read1: Column, read2: Column, single: Column) -> Column:
    """Why the file lists of a read set contradict its layout, or null."""
    n1, n2, ns = F.coalesce(F.size(read1), F.lit(0)), F.coalesce(F.size(read2), F.lit(0)), F.coalesce(F.size(single), F.lit(0))
    pairs = (n1 + n2) > 0
    return (
        F.when(pairs & ((n1 == 0) | (n1 != n2)), F.lit("paired input needs matching read1/read2 files"))
        .when((layout == SINGLE) & ((ns == 0) | pairs), F.lit("single-end input needs only single files"))
        .when((layout == PAIRED) & ((n1 == 0) | (ns > 0)), F.lit("paired input needs only read1/read2 files"))
        .when((layout == MIXED) & ((n1 == 0) | (ns == 0)), F.lit("mixed input needs paired and single files"))
    )


@dataclass(frozen=True)
class MixedLayoutRules:
    """Limits of the check that a single-end branch is not a by-product of the pairs."""

    # The default limits.
    enabled: bool = True
    count_tolerance: float = 0.001
    max_short_read_length: float = 30
    min_length_ratio: float = 0.5
    min_retained_fraction: float = 0.1


def general_number(value: Column, digits: int = 6) -> Column:
    """Number with at most ``digits`` significant digits and no trailing zeros."""
    exact = F.format_string(f"%.{digits - 1}e", value)
    rounded = exact.cast("double")
    plain = F.regexp_replace(F.regexp_replace(F.format_string("%.10f", rounded), "0+$", ""), r"\.$", "")
    mantissa = F.regexp_replace(F.regexp_replace(F.split_part(exact, F.lit("e"), F.lit(1)), "0+$", ""), r"\.$", "")
    scientific = F.concat(mantissa, F.lit("e"), F.split_part(exact, F.lit("e"), F.lit(2)))
    small = (F.abs(rounded) < 1e-4) | (F.abs(rounded) >= float(10**digits))
    return F.when(rounded == 0, F.lit("0")).when(small, scientific).otherwise(plain)


def summary_problem(prefix: str, *, second_mate: bool) -> Column:
    """Why a read summary with column prefix ``prefix`` is unusable, or null."""
    before, after = F.col(f"{prefix}_before_reads"), F.col(f"{prefix}_after_reads")
    lengths = [F.col(f"{prefix}_read1_mean_length")]
    if second_mate:
        lengths.append(F.col(f"{prefix}_read2_mean_length"))
    absent = before.isNull() | after.isNull()
    bad = (before <= 0) | (after < 0) | (after > before)
    for length in lengths:
        absent = absent | length.isNull()
        bad = bad | (length <= 0)
    return F.when(absent, F.lit(f"{prefix}: required field is missing")).when(
        bad, F.lit(f"{prefix}: non-positive or inconsistent counts")
    )


def mixed_layout_decision(df: DataFrame, rules: MixedLayoutRules | None = None) -> DataFrame:
    """Add ``action``, ``reasons`` and the statistics behind them.

    Input columns are ``paired_…`` and ``single_…`` with ``before_reads``,
    ``after_reads``, ``read1_mean_length`` and, for pairs, ``read2_mean_length``.
    """
    rules = rules or MixedLayoutRules()
    fragments = F.col("paired_before_reads") / 2
    single_reads, single_length = F.col("single_before_reads"), F.col("single_read1_mean_length")
    difference = F.try_divide(F.abs(single_reads - fragments), F.greatest(single_reads, fragments))
    ratio = F.try_divide(single_length, F.least("paired_read1_mean_length", "paired_read2_mean_length"))
    retained = F.try_divide(F.col("single_after_reads"), single_reads)
    problem = F.coalesce(
        summary_problem("paired", second_mate=True), summary_problem("single", second_mate=False)
    )
    stats = df.withColumns(
        {
            "problem": problem,
            "paired_fragments": fragments,
            "count_relative_difference": difference,
            "single_to_paired_length_ratio": ratio,
            "single_retained_fraction": retained,
        }
    )
    diff, rat, ret = (
        F.col("count_relative_difference"),
        F.col("single_to_paired_length_ratio"),
        F.col("single_retained_fraction"),
    )
    found = F.array_compact(
        F.array(
            F.when(
                diff <= rules.count_tolerance,
                F.concat(
                    F.lit("single-read count matches paired-fragment count (relative difference "),
                    general_number(diff),
                    F.lit(")"),
                ),
            ),
            F.when(
                single_length <= rules.max_short_read_length,
                F.concat(F.lit("single-end mean length is only "), general_number(single_length), F.lit(" bp")),
            ),
            F.when(
                rat < rules.min_length_ratio,
                F.concat(
                    F.lit("single-end reads are substantially shorter than paired reads (length ratio "),
                    F.format_string("%.3f", rat),
                    F.lit(")"),
                ),
            ),
            F.when(
                ret < rules.min_retained_fraction,
                F.concat(
                    F.lit("fastp retained an unusually small single-end fraction ("),
                    F.format_string("%.3f", ret * 100),
                    F.lit("%)"),
                ),
            ),
        )
    )
    unavailable = F.concat(F.lit("mixed-layout fastp statistics are unavailable: "), F.col("problem"))
    reasons = F.when(F.col("problem").isNotNull(), F.array(unavailable)).otherwise(found)
    if not rules.enabled:
        reasons = F.array().cast("array<string>")
    judged = stats.withColumn("reasons", reasons)
    action = F.when(F.lit(not rules.enabled), F.lit("disabled")).when(
        F.size("reasons") > 0, F.lit("excluded_single_end")
    )
    return judged.withColumn("action", action.otherwise(F.lit("kept_single_end")))


def valid_read_sets(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Whether each cached read set is intact.

    ``manifests`` has ``unit_id, layout, read1, read2, single, checksums``; ``files`` is
    an inventory with ``path``, ``size``, ``sha256``. Every listed file must exist and
    not be empty, every checksum must name a listed file and match.
    """
    lists = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("read1", "read2", "single")]
    none = F.lit(None).cast("string")
    listed = F.transform(F.concat(*lists), lambda path: F.struct(path.alias("path"), F.lit(True).alias("listed"), none.alias("expected")))
    summed = F.transform(
        F.coalesce(F.map_entries("checksums"), F.array().cast("array<struct<key:string,value:string>>")),
        lambda e: F.struct(e["key"].alias("path"), F.lit(False).alias("listed"), e["value"].alias("expected")),
    )
    # A row per entry, not per list: what a set holds is carried once, however long it is.
    problem = layout_problem(F.col("layout"), F.col("read1"), F.col("read2"), F.col("single"))
    tagged = manifests.select("unit_id", problem.isNull().alias("sound"), F.explode_outer(F.concat(listed, summed)).alias("e"))
    entries = tagged.groupBy("unit_id", F.col("e.path").alias("path")).agg(
        F.bool_and("sound").alias("sound"), F.bool_or("e.listed").alias("listed"), F.min("e.expected").alias("low"), F.max("e.expected").alias("high")
    )
    matches = F.col("low").isNull() | ((F.col("low") == F.col("sha256")) & (F.col("high") == F.col("sha256")))
    good = F.col("sound") & F.col("listed") & (F.col("size") > 0) & matches
    return (
        entries.join(files.select("path", "size", "sha256"), "path", "left")
        .groupBy("unit_id")
        .agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("valid"))
    )


def unit_mapping(units: DataFrame) -> DataFrame:
    """Mapping rows for the coverage tool from ``unit_id, bam, metadata, genome``."""
    return units.select(
        safe_identifier(F.col("unit_id")).alias("id"),
        "bam",
        "metadata",
        "genome",
        F.lit("ATAC").alias("assay"),
        F.concat(F.lit("placeholder-"), F.sha2("unit_id", 256)).alias("source"),
    )
