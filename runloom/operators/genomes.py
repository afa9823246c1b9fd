"""Reference assemblies: report normalization, admission, ranking and selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import blank_to_null, first_path, lenient_int, truthy_number
from ..ordering import ORD, group_sizes, keep_last, upsert_last_wins
from ..violations import violation_rows

# Assembly levels from worst to best, and statuses that rule one out.
LEVELS = {"contig": 1, "scaffold": 2, "chromosome": 3, "complete genome": 4}
BARRED_STATUS = ("suppressed", "replaced", "withdrawn", "anomalous")

# Report paths of each candidate column, in order of preference.
REPORT_PATHS = {
    "accession": ["accession", "current_accession"],
    "taxid": ["organism.tax_id", "organism.taxid", "tax_id"],
    "scientific_name": ["organism.organism_name", "organism_name"],
    "source_database": ["source_database", "assembly_info.source_database"],
    "assembly_status": ["assembly_info.assembly_status", "assembly_status"],
    "refseq_category": ["assembly_info.refseq_category", "refseq_category"],
    "assembly_level": ["assembly_info.assembly_level", "assembly_level"],
    "release_date": ["assembly_info.release_date", "release_date"],
    "contig_n50": ["assembly_stats.contig_n50", "contig_n50"],
    "scaffold_n50": ["assembly_stats.scaffold_n50", "scaffold_n50"],
    "total_length": ["assembly_stats.total_sequence_length", "total_sequence_length", "total_length"],
}
INTEGER_COLUMNS = ("taxid", "contig_n50", "scaffold_n50", "total_length")
ATYPICAL_PATHS = ["assembly_info.is_atypical", "assembly_info.atypical", "is_atypical"]
WARNING_PATHS = ["assembly_info.assembly_status_notes", "assembly_info.warnings", "warnings"]

GENOME_COLUMNS = (
    "taxid BIGINT, scientific_name STRING, accession STRING, fasta STRING, sha256 STRING,"
    " source_database STRING, assembly_level STRING, refseq_category STRING,"
    " selection_rationale ARRAY<STRING>, indexes MAP<STRING, STRING>"
)


@dataclass(frozen=True)
class GenomeSelectionPolicy:
    """Which assemblies are admitted and what is preferred among them."""

    allow_atypical: bool = False
    minimum_assembly_level: str | None = None
    prefer_reference: bool = True
    prefer_refseq: bool = True

    def __post_init__(self) -> None:
        if self.minimum_assembly_level and self.minimum_assembly_level.lower() not in LEVELS:
            raise ValueError(f"unknown assembly level: {self.minimum_assembly_level}")


def _warnings(report: Column) -> Column:
    document = F.try_parse_json(report)
    found = F.lit(None).cast("array<string>")
    for path in reversed(WARNING_PATHS):
        node = F.try_variant_get(document, f"$.{path}", "variant")
        text = F.try_variant_get(document, f"$.{path}", "string")
        listed = F.coalesce(
            F.try_variant_get(document, f"$.{path}", "array<string>"),
            F.when(F.schema_of_variant(node) == "STRING", F.array(text)),
            F.array().cast("array<string>"),
        )
        found = F.when(F.coalesce(text, F.lit("")) != "", listed).otherwise(found)
    return F.coalesce(found, F.array().cast("array<string>"))


def candidates_from_reports(reports: DataFrame, *passed: str) -> DataFrame:
    """Candidate columns from JSON assembly reports in column ``report``."""
    columns = []
    for name, paths in REPORT_PATHS.items():
        value = first_path(F.col("report"), *paths)
        if name in INTEGER_COLUMNS:
            value = lenient_int(value)
        elif name == "accession":
            value = F.coalesce(value, F.lit(""))
        columns.append(value.alias(name))
    flagged = F.coalesce(~first_path(F.col("report"), *ATYPICAL_PATHS).isin("false", "0", "[]", "{}"), F.lit(False))
    listed = reports.select(*passed, "report", *columns, _warnings(F.col("report")).alias("warnings"), flagged.alias("_flag"))
    noted = F.exists("warnings", lambda w: F.lower(w).contains("atypical"))
    return listed.select(
        *passed, *REPORT_PATHS, (F.col("_flag") | noted).alias("atypical"), "warnings", F.col("report").alias("raw")
    )


def distinct_candidates(candidates: DataFrame, *scope: str) -> DataFrame:
    """Last report per accession; reports without an accession are dropped."""
    named = candidates.filter(F.coalesce("accession", F.lit("")) != "")
    return keep_last(named, [*scope, "accession"])


def _level(column: Column) -> Column:
    score = F.lit(0)
    for name, value in LEVELS.items():
        score = F.when(F.lower(column) == name, F.lit(value)).otherwise(score)
    return score


def is_allowed(taxid: Column, policy: GenomeSelectionPolicy) -> Column:
    """Whether a candidate row may serve the requested taxonomy id."""
    status = F.lower(F.coalesce(blank_to_null(F.col("assembly_status")), F.lit("current")))
    allowed = F.coalesce(F.col("accession"), F.lit("")) != ""
    allowed = allowed & (F.col("taxid").isNull() | (F.col("taxid") == taxid))
    for word in BARRED_STATUS:
        allowed = allowed & ~status.contains(word)
    if not policy.allow_atypical:
        allowed = allowed & ~F.coalesce(F.col("atypical"), F.lit(False))
    if policy.minimum_assembly_level:
        minimum = LEVELS[policy.minimum_assembly_level.lower()]
        allowed = allowed & (_level(F.col("assembly_level")) >= minimum)
    return allowed


def rank(policy: GenomeSelectionPolicy) -> Column:
    """Ordering of candidates as a struct; the largest is the best."""
    category = F.lower(F.coalesce(F.col("refseq_category"), F.lit("")))
    reference = F.when(category.contains("reference"), 2).when(category.contains("representative"), 1).otherwise(0)
    refseq = F.lower(F.coalesce(F.col("source_database"), F.lit(""))).contains("refseq").cast("int")
    return F.struct(
        (reference if policy.prefer_reference else F.lit(0)).alias("reference"),
        (refseq if policy.prefer_refseq else F.lit(0)).alias("refseq"),
        _level(F.col("assembly_level")).alias("level"),
        truthy_number(F.col("scaffold_n50"), F.col("contig_n50")).alias("n50"),
        F.coalesce(F.col("total_length"), F.lit(0)).alias("total_length"),
        F.coalesce(F.col("release_date"), F.lit("")).alias("release_date"),
        F.col("accession").alias("accession"),
    )


def rationale() -> Column:
    """Seven lines that explain why a candidate row was selected."""
    def line(label: str, value: Column, fallback: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(blank_to_null(value), F.lit(fallback)))

    n50 = F.nullif(truthy_number(F.col("scaffold_n50"), F.col("contig_n50")), F.lit(0))
    return F.array(
        line("exact species taxid", F.col("taxid"), "None"),
        line("assembly status", F.col("assembly_status"), "current/unspecified"),
        line("RefSeq category", F.col("refseq_category"), "none"),
        line("source database", F.col("source_database"), "unspecified"),
        line("assembly level", F.col("assembly_level"), "unspecified"),
        line("scaffold/contig N50", n50, "unknown"),
        line("release date tie-breaker", F.col("release_date"), "unknown"),
    )


def select_genomes(
    candidates: DataFrame, requests: DataFrame, policy: GenomeSelectionPolicy | None = None
) -> tuple[DataFrame, DataFrame]:
    """The best candidate per request, and the requests that cannot be served.

    ``requests`` is ``(requested_taxid, pin)``, ``candidates`` carries the
    ``requested_taxid`` it was reported for. A pin bypasses admission and ranking. The
    choice is a ``max_by`` over the rank, so a species with any number of candidates is
    reduced on the map side.
    """
    policy = policy or GenomeSelectionPolicy()
    wanted = requests.select("requested_taxid", blank_to_null(F.col("pin")).alias("pin"))
    joined = candidates.join(wanted, "requested_taxid")
    eligible = F.when(
        F.col("pin").isNotNull(), F.col("accession") == F.col("pin")
    ).otherwise(is_allowed(F.col("requested_taxid"), policy))
    columns = [c for c in candidates.columns if c not in ("requested_taxid", ORD)]
    best = (
        joined.filter(eligible)
        .groupBy("requested_taxid")
        .agg(F.max_by(F.struct(*columns), rank(policy)).alias("best"))
    )
    served = wanted.join(best, "requested_taxid", "left")
    wrong_pin = F.col("pin").isNotNull() & F.coalesce(
        F.col("best.taxid") != F.col("requested_taxid"), F.lit(False)
    )
    selected = (
        served.filter(F.col("best").isNotNull() & ~wrong_pin)
        .select("requested_taxid", "pin", "best.*")
        .withColumn("selection_rationale", rationale())
    )
    detail = (
        F.when(wrong_pin, F.concat(F.lit("pinned genome "), F.col("pin"), F.lit(" belongs to taxid "), F.col("best.taxid").cast("string")))
        .when(F.col("pin").isNotNull(), F.concat(F.lit("pinned genome "), F.col("pin"), F.lit(" was not reported")))
        .otherwise(F.lit("no assembly satisfies the policy"))
    )
    violations = violation_rows(
        served.filter(F.col("best").isNull() | wrong_pin), "select_genomes", F.col("requested_taxid"), detail
    )
    return selected, violations


def cache_inventory(requirements: DataFrame, genomes: DataFrame, files: DataFrame) -> DataFrame:
    """Whether each distinct ``(taxid, pin)`` is served by a registered, intact genome.

    ``files`` is an inventory with ``path``, ``size`` and ``sha256``.
    """
    wanted = requirements.select("taxid", blank_to_null(F.col("pin")).alias("pin")).distinct()
    locked = genomes.select("taxid", "accession", "fasta", F.col("sha256").alias("_expected"))
    actual = files.select(F.col("path").alias("fasta"), "size", F.col("sha256").alias("_actual"))
    hit = (
        (F.col("pin").isNull() | (F.col("accession") == F.col("pin")))
        & (F.col("size") > 0)
        & (F.col("_expected") == F.col("_actual"))
    )
    return (
        wanted.join(locked, "taxid", "left")
        .join(actual, "fasta", "left")
        .select("taxid", "pin", "accession", F.coalesce(hit, F.lit(False)).alias("cached"))
    )


def cache_counts(inventory: DataFrame) -> DataFrame:
    """Number of cached and missing requirements."""
    return inventory.agg(
        F.count_if("cached").alias("cached"), F.count_if(~F.col("cached")).alias("missing")
    )


def upsert_genomes(genomes: DataFrame, new: DataFrame) -> DataFrame:
    """Register genomes by taxonomy id, replacing earlier ones."""
    return upsert_last_wins(genomes, new, "taxid")


def custom_genome(files: DataFrame, *, taxid: int, scientific_name: str, accession: str) -> DataFrame:
    """A genome row for a user file given as an inventory row (path, size, sha256)."""
    return files.filter("size > 0").select(
        F.lit(taxid).cast("bigint").alias("taxid"),
        F.lit(scientific_name).alias("scientific_name"),
        F.lit(accession).alias("accession"),
        F.col("path").alias("fasta"),
        "sha256",
        F.lit("custom").alias("source_database"),
        F.lit(None).cast("string").alias("assembly_level"),
        F.lit(None).cast("string").alias("refseq_category"),
        F.array(F.lit("user-supplied genome")).alias("selection_rationale"),
        F.create_map().cast("map<string,string>").alias("indexes"),
        *([ORD] if ORD in files.columns else []),
    )


def duplicate_reports(candidates: DataFrame) -> DataFrame:
    """Accessions reported more than once."""
    return group_sizes(candidates, ["accession"]).filter("_n > 1")
