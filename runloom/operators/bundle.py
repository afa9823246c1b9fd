"""Linked metadata collections: subsets, completeness, merging and attachment to runs."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_numeric_id
from ..functions.values import (
    blank_to_null,
    lenient_float,
    lenient_int_via_float,
    sorted_attribute_json,
)
from ..ordering import (
    ORD,
    distinct_in_order,
    group_sizes,
    keep_first,
    pack_ordered,
    union_first_wins,
    upsert_last_wins,
    with_order,
)
from ..session import cut_lineage
from ..sources.schemas import struct_type
from ..violations import require_none, violation_rows

ACCESSION_COLLECTIONS = (
    "packages",
    "runs",
    "experiments",
    "sra_samples",
    "studies",
    "submissions",
    "biosamples",
)


def raw_identity(raw: Column) -> Column:
    """Digest of a canonical JSON tree; equal trees are one record."""
    return F.sha2(raw, 256)


def accession_unique(df: DataFrame) -> DataFrame:
    """First record per accession; records without one are dropped."""
    return keep_first(df.filter(F.coalesce("accession", F.lit("")) != ""), ["accession"])


def run_links(packages: DataFrame) -> DataFrame:
    """One row per package and linked run, with the position of the run."""
    return packages.select(
        "experiment_accession",
        "accession",
        F.posexplode("run_accessions").alias("pos", "run_accession"),
    )


def linked_subset(entity: DataFrame, links: DataFrame, column: str) -> DataFrame:
    """Entity rows whose accession appears in a link column."""
    wanted = links.filter(F.coalesce(F.col(column), F.lit("")) != "").select(
        F.col(column).alias("accession")
    )
    return entity.join(wanted, "accession", "left_semi")


def complete_experiments(
    packages: DataFrame,
    experiments: DataFrame,
    samples: DataFrame,
    biosamples: DataFrame,
    *,
    include_raw: bool = False,
) -> DataFrame:
    """Experiments whose linked records are all present (with raw trees if asked)."""
    def has_raw(df: DataFrame) -> Column:
        return F.col("raw").isNotNull() if "raw" in df.columns else F.lit(False)

    known = experiments.select(
        F.col("accession").alias("experiment_accession"), has_raw(experiments).alias("_eraw")
    )
    sample = samples.select(
        F.col("accession").alias("sra_sample_accession"),
        blank_to_null(F.col("biosample")).alias("biosample"),
        has_raw(samples).alias("_sraw"),
    )
    present = biosamples.select(
        F.col("accession").alias("biosample"), F.lit(True).alias("_found"), has_raw(biosamples).alias("_braw")
    )
    linked = (
        packages.filter(F.coalesce("experiment_accession", F.lit("")) != "")
        .select("experiment_accession", "sra_sample_accession")
        .join(known, "experiment_accession")
        .join(sample, "sra_sample_accession")
        .join(present, "biosample", "left")
    )
    complete = F.col("biosample").isNull() | F.col("_found").isNotNull()
    if include_raw:
        complete = complete & F.col("_eraw") & F.col("_sraw")
        complete = complete & (F.col("_found").isNull() | F.col("_braw"))
    return linked.filter(complete).select("experiment_accession").distinct()


def known_identifiers(*entities: DataFrame) -> DataFrame:
    """Every accession, alias and identifier value that names a loaded record."""
    parts = []
    for df in entities:
        listed = [F.col("accession")]
        if "alias" in df.columns:
            listed.append(F.col("alias"))
        values = F.array(*listed)
        if "identifiers" in df.columns:
            values = F.concat(
                values,
                F.coalesce(F.col("identifiers")["value"], F.array().cast("array<string>")),
            )
        parts.append(df.select(F.explode(values).alias("accession")))
    known = parts[0]
    for part in parts[1:]:
        known = known.unionByName(part)
    return known.filter(F.coalesce("accession", F.lit("")) != "")


def missing_accessions(requested: DataFrame, *entities: DataFrame) -> DataFrame:
    """Requested accessions that no loaded record carries; internal numbers are ignored."""
    wanted = requested.select("accession").distinct().filter(~is_numeric_id(F.col("accession")))
    return wanted.join(known_identifiers(*entities), "accession", "left_anti")


def fetch_plan(
    requested: DataFrame, complete: DataFrame, index: DataFrame | None = None, *, refresh: bool = False
) -> DataFrame:
    """Requested experiments that still have to be fetched.

    An index may only withdraw completeness; it never hides records that are absent.
    """
    wanted = requested.select("experiment_accession").distinct()
    if refresh:
        return wanted
    done = complete.select("experiment_accession")
    if index is not None:
        listed = index.filter("complete").select("experiment_accession")
        done = done.join(listed, "experiment_accession", "left_semi")
    return wanted.join(done, "experiment_accession", "left_anti")


def experiments_with_runs(packages: DataFrame, runs: DataFrame) -> DataFrame:
    """Experiments that contain at least one of the given runs (column ``Run``)."""
    wanted = runs.filter(F.col("Run").isNotNull()).select(F.col("Run").cast("string").alias("run_accession"))
    return (
        run_links(packages)
        .join(wanted, "run_accession", "left_semi")
        .select("experiment_accession")
        .distinct()
    )


def linked_biosamples(samples: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Distinct BioSamples of the samples, followed by those only the catalog names.

    The two inputs may carry different order types, so the order is kept as text.
    """
    named = samples.select(F.col("biosample").alias("accession"), F.lit(0).alias("_src"), F.to_json(F.struct(ORD)).alias(ORD))
    if catalog is not None and "BioSample" in catalog.columns:
        named = named.unionByName(
            catalog.select(F.col("BioSample").cast("string").alias("accession"), F.lit(1).alias("_src"), F.to_json(F.struct(ORD)).alias(ORD))
        )
    filled = named.filter(F.coalesce("accession", F.lit("")) != "")
    return distinct_in_order(
        filled.select("accession", F.struct("_src", ORD).alias(ORD)), ["accession"]
    )


def agreement_violations(df: DataFrame, keys: list[str], operator: str) -> DataFrame:
    """Keys whose repeated rows are not identical.

    Rows are compared through a digest, so two aggregates of fixed size per key do.
    """
    rest = [c for c in df.columns if c not in keys and c != ORD]
    digest = F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)
    bounds = df.groupBy(*keys).agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"))
    return violation_rows(
        bounds.filter("_lo <> _hi"),
        operator,
        F.concat_ws("/", *keys),
        F.lit("repeated records differ"),
    )


def completeness_index(packages: DataFrame, experiments: DataFrame, samples: DataFrame, biosamples: DataFrame) -> DataFrame:
    """Sample, BioSample and completeness (without and with raw trees) per experiment; the last package wins.

    Packages and experiments meet in one aggregate by experiment. Both verdicts come from the
    same row, so no link is joined twice and a task sorts one table instead of six.
    """
    def has_raw(df: DataFrame) -> Column:
        return F.coalesce(F.col("raw").isNotNull(), F.lit(False)) if "raw" in df.columns else F.lit(False)

    sample = samples.select(
        F.col("accession").alias("sra_sample_accession"), "biosample", blank_to_null(F.col("biosample")).alias("_bio"), has_raw(samples).alias("_sraw"),
    )
    present = biosamples.select(F.col("accession").alias("_bio"), has_raw(biosamples).alias("_braw"))
    loaded = F.col("_sraw").isNotNull() & (F.col("_bio").isNull() | F.col("_braw").isNotNull())
    linked = (
        packages.filter(F.coalesce("experiment_accession", F.lit("")) != "")
        .select("experiment_accession", "sra_sample_accession", ORD)
        .join(sample, "sra_sample_accession", "left")
        .join(present, "_bio", "left")
        .select(
            "experiment_accession",
            F.when(F.coalesce("sra_sample_accession", F.lit("")) != "", F.col(ORD)).alias("_place"),
            F.col("sra_sample_accession").alias("sra_sample"),
            "biosample",
            loaded.alias("_loaded"),
            (loaded & F.col("_sraw") & F.coalesce("_braw", F.lit(True))).alias("_raw"),
            F.lit(False).alias("_known"),
            F.lit(False).alias("_eraw"),
        )
    )
    known = experiments.select(F.col("accession").alias("experiment_accession"), F.lit(True).alias("_known"), has_raw(experiments).alias("_eraw"))
    # Rows of experiments have no place, so none of them is the last package.
    return (
        linked.unionByName(known, allowMissingColumns=True)
        .groupBy("experiment_accession")
        .agg(
            F.max_by(F.struct("sra_sample", "biosample"), "_place").alias("_last"),
            *[F.bool_or(flag).alias(flag) for flag in ("_loaded", "_raw", "_known", "_eraw")],
        )
        .filter(F.col("_last").isNotNull())
        .select(
            "experiment_accession",
            "_last.sra_sample",
            "_last.biosample",
            (F.col("_loaded") & F.col("_known")).alias("complete"),
            (F.col("_raw") & F.col("_known") & F.col("_eraw")).alias("raw_available"),
        )
    )


def _text(column: Column) -> Column:
    return blank_to_null(column)


def run_columns(runs: DataFrame) -> DataFrame:
    """Run facts under the names they get in a catalog."""
    return runs.filter(F.coalesce("accession", F.lit("")) != "").select(
        F.col("accession").alias("Run"),
        _text(F.col("title")).alias("sra_run_title"),
        lenient_int_via_float(F.col("spots")).alias("sra_run_spots"),
        lenient_int_via_float(F.col("bases")).alias("sra_run_bases"),
        lenient_float(F.col("size_gb")).alias("sra_run_size_gb"),
        _text(F.col("published_at")).alias("sra_run_published_at"),
    )


def experiment_columns(experiments: DataFrame, studies: DataFrame) -> DataFrame:
    """Experiment facts and those of its study under their catalog names."""
    study = studies.select(
        F.col("accession").alias("study_accession"),
        _text(F.col("title")).alias("sra_study_title"),
        _text(F.col("abstract")).alias("sra_study_abstract"),
        _text(F.col("bioproject")).alias("sra_bioproject"),
    )
    library, platform = F.col("library"), F.col("platform")
    facts = experiments.filter(F.coalesce("accession", F.lit("")) != "").select(
        F.col("accession").alias("Experiment"),
        _text(F.col("title")).alias("sra_experiment_title"),
        *[
            _text(library[name]).alias(f"sra_library_{name}")
            for name in ("strategy", "source", "selection", "layout", "construction_protocol")
        ],
        _text(platform["instrument_model"]).alias("sra_instrument_model"),
        "study_accession",
    )
    return facts.join(study, "study_accession", "left").select(
        *facts.columns[:-1],
        _text(F.col("study_accession")).alias("sra_study_accession"),
        "sra_study_title",
        "sra_study_abstract",
        "sra_bioproject",
    )


def sample_columns(samples: DataFrame) -> DataFrame:
    """Sample facts under their catalog names."""
    return samples.filter(F.coalesce("accession", F.lit("")) != "").select(
        F.col("accession").alias("Sample"),
        _text(F.col("title")).alias("sra_sample_title"),
        sorted_attribute_json(F.col("attributes")).alias("sra_sample_attributes_json"),
    )


def biosample_columns(biosamples: DataFrame) -> DataFrame:
    """BioSample facts under their catalog names."""
    return biosamples.filter(F.coalesce("accession", F.lit("")) != "").select(
        F.col("accession").alias("BioSample"),
        _text(F.col("title")).alias("biosample_title"),
        _text(F.col("organism")).alias("biosample_organism"),
        sorted_attribute_json(F.col("attributes")).alias("biosample_attributes_json"),
    )


@dataclass(frozen=True)
class Bundle:
    """The linked collections; absent ones are ``None`` and count as empty."""

    packages: DataFrame | None = None
    runs: DataFrame | None = None
    experiments: DataFrame | None = None
    sra_samples: DataFrame | None = None
    studies: DataFrame | None = None
    submissions: DataFrame | None = None
    biosamples: DataFrame | None = None
    raw_sra_packages: DataFrame | None = None

    def filled(self, spark: SparkSession) -> Bundle:
        """The same bundle with empty tables in place of absent collections."""
        changes = {}
        for field in fields(self):
            if getattr(self, field.name) is None:
                empty = spark.createDataFrame([], struct_type(field.name))
                changes[field.name] = with_order(empty)
        return replace(self, **changes)

    def _map(self, change) -> Bundle:
        return Bundle(**{f.name: change(f.name, getattr(self, f.name)) for f in fields(self)})

    def reachable(self, accessions: DataFrame) -> DataFrame:
        """``(collection, accession)`` that the packages of some experiments link, each once.

        The table is checkpointed: every collection is then cut by it with one reading of
        its own, instead of deriving the packages anew.
        """
        packages = self.packages.join(accessions.select("experiment_accession"), "experiment_accession", "left_semi")

        def link(collection: str, accession: Column) -> Column:
            return F.struct(F.lit(collection).alias("collection"), accession.alias("accession"))

        single = F.array(
            link("sra_samples", F.col("sra_sample_accession")),
            link("studies", F.col("study_accession")),
            link("submissions", F.col("submission_accession")),
        )
        empty = F.array().cast("array<struct<collection:string,accession:string>>")
        runs = F.coalesce(F.transform("run_accessions", lambda r: link("runs", r)), empty)
        links = packages.select(F.inline(F.concat(single, runs))).filter(F.coalesce("accession", F.lit("")) != "")
        return cut_lineage(links.distinct())

    def subset_experiments(self, accessions: DataFrame) -> Bundle:
        """The given experiments (column ``experiment_accession``) and all linked records."""
        wanted = accessions.select("experiment_accession")
        links = self.reachable(wanted)

        def cut(name: str) -> DataFrame:
            return getattr(self, name).join(links.filter(F.col("collection") == name).select("accession"), "accession", "left_semi")

        return Bundle(
            packages=self.packages.join(wanted, "experiment_accession", "left_semi"),
            experiments=linked_subset(self.experiments, wanted, "experiment_accession"),
            biosamples=linked_subset(self.biosamples, cut("sra_samples"), "biosample"),
            raw_sra_packages=self.raw_sra_packages.join(wanted, "experiment_accession", "left_semi"),
            **{name: cut(name) for name in ("runs", "sra_samples", "studies", "submissions")},
        )

    def complete_experiment_accessions(self, *, include_raw: bool = False) -> DataFrame:
        """See ``complete_experiments``."""
        return complete_experiments(
            self.packages, self.experiments, self.sra_samples, self.biosamples, include_raw=include_raw
        )

    def scoped_to_runs(self, runs: DataFrame) -> Bundle:
        """The experiments that contain a requested run, and their records."""
        return self.subset_experiments(experiments_with_runs(self.packages, runs))

    def merged_with(self, source: Bundle) -> Bundle:
        """First-wins union, used for the pages of one fetch."""
        return self._map(
            lambda name, df: df.unionByName(getattr(source, name))
            if name == "raw_sra_packages"
            else union_first_wins(df, getattr(source, name), "accession")
        )

    def upserted_from(self, source: Bundle) -> Bundle:
        """Last-wins upsert; raw trees are distinct by content."""

        def change(name: str, df: DataFrame) -> DataFrame:
            incoming = getattr(source, name)
            if name != "raw_sra_packages":
                return upsert_last_wins(df, incoming, "accession")
            both = df.unionByName(incoming).withColumn("_id", raw_identity(F.col("raw")))
            return keep_first(both, ["_id"]).drop("_id")

        return self._map(change)

    def completeness_index(self) -> DataFrame:
        """See ``completeness_index``."""
        return completeness_index(self.packages, self.experiments, self.sra_samples, self.biosamples)

    def attach_to_runs(self, catalog):
        """Left-join run, experiment, sample and BioSample facts onto a catalog.

        Runs and experiments are about as many as the rows of the catalog, so neither side is
        broadcast. Their facts are one row per accession and are hashed by partition: the rows
        of the catalog, which every join widens, pass by without being sorted.
        """
        frame = catalog.frame
        for collection, key, facts in (
            ("runs", "Run", lambda: run_columns(self.runs).hint("shuffle_hash")),
            ("experiments", "Experiment", lambda: experiment_columns(self.experiments, self.studies).hint("shuffle_hash")),
            ("sra_samples", "Sample", lambda: sample_columns(self.sra_samples)),
            ("biosamples", "BioSample", lambda: biosample_columns(self.biosamples)),
        ):
            if getattr(self, collection) is not None and key in frame.columns:
                frame = frame.join(facts(), key, "left")
        return catalog.replace_frame(frame, event="attached normalized metadata")

    def missing_samples(self) -> DataFrame:
        """Packages that link a sample which is not loaded, as violation rows."""
        linked = self.packages.filter(
            (F.coalesce("experiment_accession", F.lit("")) != "")
            & (F.coalesce("sra_sample_accession", F.lit("")) != "")
        )
        lost = linked.join(
            self.sra_samples.select(F.col("accession").alias("sra_sample_accession")),
            "sra_sample_accession",
            "left_anti",
        )
        return violation_rows(
            lost,
            "full_descriptions",
            F.col("experiment_accession"),
            F.concat(F.lit("links missing sample "), F.col("sra_sample_accession")),
        )

    def full_descriptions(self, *, strict: bool = True) -> tuple[DataFrame, DataFrame]:
        """Complete linked records per experiment, and the runs of each as rows.

        Runs stay in a table of their own ``(experiment_accession, pos, run)`` because an
        experiment may own any number of them; ``packed_runs`` makes bounded arrays.
        """
        if strict:
            require_none(self.missing_samples())

        def record(df: DataFrame, name: str) -> DataFrame:
            kept = [c for c in df.columns if c != ORD]
            return df.select(F.col("accession").alias(f"_{name}"), F.struct(*kept).alias(name))

        linked = self.packages.filter(
            (F.coalesce("experiment_accession", F.lit("")) != "")
            & (F.coalesce("sra_sample_accession", F.lit("")) != "")
        )
        relation = [c for c in linked.columns if c not in (ORD, "run_accessions")]
        joined = (
            linked.withColumn("package_relation", F.struct(*relation))
            .join(record(self.sra_samples, "sra_sample"), F.col("sra_sample_accession") == F.col("_sra_sample"))
            .join(record(self.experiments, "experiment"), F.col("experiment_accession") == F.col("_experiment"), "left")
            .join(record(self.biosamples, "biosample"), F.col("sra_sample.biosample") == F.col("_biosample"), "left")
            .join(record(self.studies, "study"), F.col("study_accession") == F.col("_study"), "left")
            .join(record(self.submissions, "submission"), F.col("submission_accession") == F.col("_submission"), "left")
        )
        described = joined.select(
            F.lit("1.0").alias("schema_version"),
            F.col("experiment_accession").alias("experiment_id"),
            F.col("sra_sample_accession").alias("sra_sample_id"),
            F.col("sra_sample.biosample").alias("biosample_id"),
            "experiment",
            "sra_sample",
            "biosample",
            "study",
            "submission",
            "package_relation",
            ORD,
        )
        if strict:
            require_none(agreement_violations(described, ["experiment_id"], "full_descriptions"))
        # One relation per experiment is described, and only its runs belong to it; an
        # experiment none of whose samples is loaded keeps the runs of its first relation.
        known = self.sra_samples.select(F.col("accession").alias("_known")).distinct()
        relations = linked.join(known, F.col("sra_sample_accession") == F.col("_known"), "left")
        place = F.struct(F.col("_known").isNull(), F.col(ORD))
        kept = keep_first(relations, ["experiment_accession"], place).drop("_known")
        runs = run_links(kept).join(
            record(self.runs, "run"), F.col("run_accession") == F.col("_run")
        )
        return keep_first(described, ["experiment_id"]), runs.select(
            F.col("experiment_accession").alias("experiment_id"), "pos", "run"
        )


def packed_runs(runs: DataFrame, limit: int = 1_000) -> DataFrame:
    """Run records of each experiment as arrays in link order, in bounded chunks."""
    keyed = runs.withColumn("_run", F.to_json("run"))
    return pack_ordered(keyed, ["experiment_id"], "_run", "pos", limit).select(
        "experiment_id", "chunk", "n_chunks", F.col("values").alias("runs")
    )


def duplicate_accessions(df: DataFrame) -> DataFrame:
    """Accessions that occur more than once in a collection."""
    return group_sizes(df, ["accession"]).filter("_n > 1").select("accession", F.col("_n").alias("n"))
