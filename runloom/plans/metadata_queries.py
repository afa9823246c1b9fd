"""Linked metadata, description and assembly queries on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bundle as bd
from ..operators import descriptions as ds
from ..operators import genomes as gn
from ..operators.catalog import RunCatalog
from ..ordering import ORD, keep_first, pack_ordered, union_first_wins, upsert_last_wins, with_order
from .registry import Tables, query

MISSING_SAMPLE_NATION = 7
RAW_NATIONS = 12
#: Lines that are joined and made distinct in one task, about.
TASK_LINES = 500_000

SQL_BUNDLE = f"""
runs AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS accession, 'SRX' || l_orderkey AS experiment_accession, l_linenumber AS pos FROM lineitem),
packages AS (SELECT 'SRX' || o_orderkey AS experiment_accession, 'SRS' || o_custkey AS sra_sample_accession, 'SRP' || (o_custkey % 25) AS study_accession, 'SRA' || (o_orderkey % 6) AS submission_accession, o_orderkey FROM orders),
experiments AS (SELECT 'SRX' || o_orderkey AS accession, 'order ' || o_orderpriority AS title, 'SRP' || (o_custkey % 25) AS study_accession, o_orderpriority AS design_description, o_orderstatus AS strategy, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' ELSE 'PAIRED' END AS layout, o_orderkey FROM orders WHERE o_orderkey % 13 <> 0),
samples AS (SELECT 'SRS' || c_custkey AS accession, CASE WHEN c_nationkey <> 3 THEN 'SAMN' || c_nationkey END AS biosample, c_name AS title, 'Homo ' || lower(c_mktsegment) AS organism, c_mktsegment, c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_nationkey <> {MISSING_SAMPLE_NATION}),
biosamples AS (SELECT 'SAMN' || n_nationkey AS accession, n_name AS title, n_nationkey FROM nation WHERE n_nationkey < 20),
studies AS (SELECT 'SRP' || n_nationkey AS accession, 'Study ' || n_name AS title, 'About ' || n_name AS abstract, 'PRJ' || n_regionkey AS bioproject FROM nation),
submissions AS (SELECT 'SRA' || r_regionkey AS accession, r_name, r_regionkey FROM region)
"""


def package_links(t: Tables) -> DataFrame:
    """Orders as experiment packages without run lists."""
    return t.orders.select(
        F.concat(F.lit("SRX"), "o_orderkey").alias("accession"),
        F.concat(F.lit("SRX"), "o_orderkey").alias("experiment_accession"),
        F.concat(F.lit("SRP"), F.col("o_custkey") % 25).alias("study_accession"),
        F.concat(F.lit("SRS"), "o_custkey").alias("sra_sample_accession"),
        F.concat(F.lit("SRA"), F.col("o_orderkey") % 6).alias("submission_accession"),
        F.col("o_orderkey").alias(ORD),
    )


def packages_of(t: Tables) -> DataFrame:
    """Orders as experiment packages that list their lines as runs."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    listed = pack_ordered(
        lines.select("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("run"), F.col("l_linenumber").alias(ORD)),
        ["l_orderkey"],
        "run",
    ).select(F.col("l_orderkey").alias("o_orderkey"), F.col("values").alias("run_accessions"))
    listed = listed.withColumnRenamed("o_orderkey", ORD)
    return package_links(t).join(listed, ORD, "left").withColumn(
        "run_accessions", F.coalesce("run_accessions", F.array().cast("array<string>"))
    )


def spread_lines(t: Tables, *columns: str) -> DataFrame:
    """Columns of the lines by order, in partitions of bounded size however many lines there are."""
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.lineitem.select("l_orderkey", *columns).repartition(max(tasks, t.lineitem.count() // TASK_LINES), "l_orderkey")


def bundle_of(t: Tables, *, with_runs: bool = True) -> bd.Bundle:
    """The test tables as a metadata bundle; see ``SQL_BUNDLE``.

    Descriptions without runs leave out the run lists of the packages.
    """
    spark = t.spark
    no_records = F.lit(None).cast("array<struct<name:string,value:string,units:string,properties:map<string,string>>>")
    experiments = t.orders.filter("o_orderkey % 13 <> 0").select(
        F.concat(F.lit("SRX"), "o_orderkey").alias("accession"),
        F.concat(F.lit("order "), "o_orderpriority").alias("title"),
        F.concat(F.lit("SRP"), F.col("o_custkey") % 25).alias("study_accession"),
        F.col("o_orderpriority").alias("design_description"),
        F.struct(
            F.lit(None).cast("string").alias("name"),
            F.col("o_orderstatus").alias("strategy"),
            F.lit("GENOMIC").alias("source"),
            F.lit("").alias("selection"),
            F.when(F.col("o_orderkey") % 11 == 0, F.lit("missing")).otherwise(F.lit("PAIRED")).alias("layout"),
            F.create_map(F.lit("nominal_length"), F.lit("300")).alias("layout_properties"),
            F.lit(None).cast("string").alias("construction_protocol"),
        ).alias("library"),
        F.struct(F.lit("ILLUMINA").alias("name"), F.lit("not provided").alias("instrument_model")).alias("platform"),
        F.create_map(
            F.lit("Experimental Factor: Tissue"),
            F.array(F.when(F.col("o_orderkey") % 4 == 0, F.lit("assay tissue"))),
        ).alias("_factors"),
        F.lit("raw").alias("raw"),
        F.col("o_orderkey").alias(ORD),
    ).withColumn("attributes", F.map_filter("_factors", lambda k, v: v[0].isNotNull())).drop("_factors")
    records = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                value.cast("string").alias("value"),
                F.lit(unit).cast("string").alias("units"),
                F.lit(None).cast("map<string,string>").alias("properties"),
            )
            for name, value, unit in (
                ("tissue_type", F.concat(F.lit("[src] "), F.initcap("c_mktsegment")), None),
                ("organ", F.lower("c_mktsegment"), None),
                ("isolation-source", F.lower("c_mktsegment"), None),
                ("age", F.col("c_custkey") % 90, "years"),
                ("collection_date", F.lit("2022-01-01"), None),
                ("disease", F.when(F.col("c_custkey") % 3 == 0, F.lit(" Not  Collected ")).otherwise(F.lit("none seen")), None),
            )
        ]
    )
    samples = t.customer.filter(F.col("c_nationkey") != MISSING_SAMPLE_NATION).select(
        F.concat(F.lit("SRS"), "c_custkey").alias("accession"),
        F.when(F.col("c_nationkey") != 3, F.concat(F.lit("SAMN"), "c_nationkey")).alias("biosample"),
        F.col("c_name").alias("title"),
        F.concat(F.lit("Homo "), F.lower("c_mktsegment")).alias("organism"),
        F.create_map(F.lit("segment"), F.array("c_mktsegment")).alias("attributes"),
        records.alias("attribute_records"),
        F.when(F.col("c_nationkey") < RAW_NATIONS, F.lit("raw")).alias("raw"),
        F.col("c_custkey").alias(ORD),
    )
    biosamples = t.nation.filter("n_nationkey < 20").select(
        F.concat(F.lit("SAMN"), "n_nationkey").alias("accession"),
        F.col("n_name").alias("title"),
        F.col("n_name").alias("organism"),
        F.concat(F.lit("from "), "n_name").alias("comment"),
        F.create_map(F.lit("sex"), F.array(F.lit("female"))).alias("attributes"),
        no_records.alias("attribute_records"),
        F.lit("raw").alias("raw"),
        F.col("n_nationkey").alias(ORD),
    )
    studies = t.nation.select(
        F.concat(F.lit("SRP"), "n_nationkey").alias("accession"),
        F.concat(F.lit("Study "), "n_name").alias("title"),
        F.concat(F.lit("About "), "n_name").alias("abstract"),
        F.concat(F.lit("PRJ"), "n_regionkey").alias("bioproject"),
        F.col("n_nationkey").alias(ORD),
    )
    submissions = t.region.select(
        F.concat(F.lit("SRA"), "r_regionkey").alias("accession"),
        F.struct(F.col("r_name").alias("name"), F.lit("GEO").alias("abbreviation")).alias("organization"),
        F.lit("center").alias("center_name"),
        F.col("r_regionkey").alias(ORD),
    )
    runs = (
        spread_lines(t, "l_linenumber")
        .distinct()
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("accession"),
            F.concat(F.lit("SRX"), "l_orderkey").alias("experiment_accession"),
            F.lit("").alias("title"),
            (F.col("l_linenumber") * 100).cast("bigint").alias("spots"),
            F.col("l_linenumber").cast("bigint").alias("bases"),
            (F.col("l_linenumber") / 4).alias("size_gb"),
            F.lit(None).cast("string").alias("published_at"),
            F.struct("l_orderkey", "l_linenumber").alias(ORD),
        )
    )
    raw = spark.createDataFrame([], f"experiment_accession STRING, raw STRING, {ORD} BIGINT")
    packages = packages_of(t) if with_runs else package_links(t)
    return bd.Bundle(packages, runs, experiments, samples, studies, submissions, biosamples, raw)


def requested_experiments(t: Tables) -> DataFrame:
    """Experiments of the customers of two nations, and a few unknown ones."""
    known = t.orders.join(
        t.customer.filter(F.col("c_nationkey").isin(2, 3)), F.col("o_custkey") == F.col("c_custkey")
    ).select(F.concat(F.lit("SRX"), "o_orderkey").alias("experiment_accession"))
    unknown = t.region.select(F.concat(F.lit("SRXnone"), "r_regionkey").alias("experiment_accession"))
    return known.unionByName(unknown)


SQL_REQUESTED = """requested AS (SELECT 'SRX' || o_orderkey AS experiment_accession FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (2, 3)
  UNION ALL SELECT 'SRXnone' || r_regionkey FROM region)"""
SQL_COMPLETE = """complete AS (SELECT DISTINCT p.experiment_accession, s.c_nationkey FROM packages p JOIN experiments e ON e.accession = p.experiment_accession
  JOIN samples s ON s.accession = p.sra_sample_accession LEFT JOIN biosamples b ON b.accession = s.biosample WHERE s.biosample IS NULL OR b.accession IS NOT NULL)"""


@query(
    "attached_run_facts",
    f"""WITH {SQL_BUNDLE}, C AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS Run, l_linenumber, 'SRX' || l_orderkey AS Experiment, 'SRS' || o_custkey AS Sample, 'SAMN' || l_suppkey AS BioSample
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT C.Run, C.Experiment, C.Sample, C.BioSample, CAST(C.l_linenumber * 100 AS BIGINT) AS sra_run_spots, C.l_linenumber / 4.0 AS sra_run_size_gb,
      e.title AS sra_experiment_title, e.strategy AS sra_library_strategy, e.study_accession AS sra_study_accession, t.title AS sra_study_title, t.bioproject AS sra_bioproject,
      CASE WHEN s.accession IS NOT NULL THEN '{{"segment": "' || s.c_mktsegment || '"}}' END AS sra_sample_attributes_json, b.title AS biosample_title
    FROM C LEFT JOIN experiments e ON e.accession = C.Experiment LEFT JOIN studies t ON t.accession = e.study_accession
    LEFT JOIN samples s ON s.accession = C.Sample LEFT JOIN biosamples b ON b.accession = C.BioSample""",
)
def attached_run_facts(t: Tables) -> DataFrame:
    """Catalog rows with the facts of their linked records."""
    frame = (
        spread_lines(t, "l_linenumber", "l_suppkey")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey")
        .distinct()
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Run"),
            F.concat(F.lit("SRX"), "l_orderkey").alias("Experiment"),
            F.concat(F.lit("SRS"), "o_custkey").alias("Sample"),
            F.concat(F.lit("SAMN"), "l_suppkey").alias("BioSample"),
            F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias(ORD),
        )
    )
    attached = bundle_of(t, with_runs=False).attach_to_runs(RunCatalog(frame)).frame
    return attached.select(
        "Run", "Experiment", "Sample", "BioSample", "sra_run_spots", "sra_run_size_gb", "sra_experiment_title",
        "sra_library_strategy", "sra_study_accession", "sra_study_title", "sra_bioproject",
        "sra_sample_attributes_json", "biosample_title",
    )


_SUBSET_SQL = f"""WITH {SQL_BUNDLE}, {SQL_REQUESTED}, P AS (SELECT * FROM packages WHERE experiment_accession IN (SELECT experiment_accession FROM requested)),
    S AS (SELECT * FROM samples WHERE accession IN (SELECT sra_sample_accession FROM P))"""


@query(
    "experiment_subset",
    f"""{_SUBSET_SQL}
    SELECT 'packages' AS collection, experiment_accession AS accession FROM P
    UNION ALL SELECT 'experiments', accession FROM experiments WHERE accession IN (SELECT experiment_accession FROM requested)
    UNION ALL SELECT 'sra_samples', accession FROM S
    UNION ALL SELECT 'studies', accession FROM studies WHERE accession IN (SELECT study_accession FROM P)
    UNION ALL SELECT 'submissions', accession FROM submissions WHERE accession IN (SELECT submission_accession FROM P)
    UNION ALL SELECT 'runs', accession FROM runs WHERE experiment_accession IN (SELECT experiment_accession FROM P)
    UNION ALL SELECT 'biosamples', accession FROM biosamples WHERE accession IN (SELECT biosample FROM S)""",
)
def experiment_subset(t: Tables) -> DataFrame:
    """All records reachable from the requested experiments."""
    subset = bundle_of(t).subset_experiments(requested_experiments(t))
    parts = None
    for name in bd.ACCESSION_COLLECTIONS:
        part = getattr(subset, name).select(F.lit(name).alias("collection"), "accession")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("complete_experiments", f"WITH {SQL_BUNDLE}, {SQL_COMPLETE} SELECT experiment_accession FROM complete")
def complete_experiments(t: Tables) -> DataFrame:
    """Experiments whose linked records are all present."""
    return bundle_of(t, with_runs=False).complete_experiment_accessions()


@query(
    "full_descriptions",
    f"""WITH {SQL_BUNDLE} SELECT p.experiment_accession AS experiment_id, p.sra_sample_accession AS sra_sample_id, s.biosample AS biosample_id,
      e.title AS experiment_title, s.organism, b.title AS biosample_title, t.title AS study_title, u.r_name AS submitter
    FROM packages p JOIN samples s ON s.accession = p.sra_sample_accession LEFT JOIN experiments e ON e.accession = p.experiment_accession
    LEFT JOIN biosamples b ON b.accession = s.biosample LEFT JOIN studies t ON t.accession = p.study_accession LEFT JOIN submissions u ON u.accession = p.submission_accession""",
)
def full_descriptions(t: Tables) -> DataFrame:
    """Complete linked records per experiment."""
    described, _ = bundle_of(t).full_descriptions(strict=False)
    return described.select(
        "experiment_id",
        "sra_sample_id",
        "biosample_id",
        F.col("experiment.title").alias("experiment_title"),
        F.col("sra_sample.organism").alias("organism"),
        F.col("biosample.title").alias("biosample_title"),
        F.col("study.title").alias("study_title"),
        F.col("submission.organization.name").alias("submitter"),
    )


@query(
    "full_description_runs",
    """WITH L AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT 'SRX' || l_orderkey AS experiment_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS BIGINT) AS pos,
      l_orderkey || '-' || l_linenumber AS run, l_linenumber / 4.0 AS size_gb FROM L""",
)
def full_description_runs(t: Tables) -> DataFrame:
    """Runs of every experiment in link order, whether or not its sample is loaded."""
    _, runs = bundle_of(t).full_descriptions(strict=False)
    return runs.select(
        "experiment_id", F.col("pos").cast("bigint").alias("pos"), F.col("run.accession").alias("run"), F.col("run.size_gb").alias("size_gb")
    )


@query(
    "missing_sample_links",
    f"""WITH {SQL_BUNDLE} SELECT experiment_accession AS key, 'links missing sample ' || sra_sample_accession AS detail
    FROM packages WHERE sra_sample_accession NOT IN (SELECT accession FROM samples)""",
)
def missing_sample_links(t: Tables) -> DataFrame:
    """Experiments whose sample is not loaded."""
    return bundle_of(t, with_runs=False).missing_samples().select("key", "detail")


@query(
    "missing_accessions",
    f"""WITH {SQL_BUNDLE}, {SQL_REQUESTED} SELECT DISTINCT experiment_accession AS accession FROM requested
    WHERE experiment_accession NOT IN (SELECT accession FROM experiments)""",
)
def missing_accessions(t: Tables) -> DataFrame:
    """Requested accessions that no record carries."""
    b = bundle_of(t)
    wanted = requested_experiments(t).select(F.col("experiment_accession").alias("accession"))
    numbers = t.region.select(F.col("r_regionkey").cast("string").alias("accession"))
    return bd.missing_accessions(wanted.unionByName(numbers), b.experiments, b.sra_samples)


@query(
    "fetch_plan",
    f"""WITH {SQL_BUNDLE}, {SQL_COMPLETE}, {SQL_REQUESTED} SELECT DISTINCT experiment_accession FROM requested
    WHERE experiment_accession NOT IN (SELECT experiment_accession FROM complete WHERE CAST(substr(experiment_accession, 4) AS BIGINT) % 2 = 0)""",
)
def fetch_plan(t: Tables) -> DataFrame:
    """Experiments to fetch when the index knows only every second one."""
    complete = bundle_of(t, with_runs=False).complete_experiment_accessions()
    index = t.orders.select(
        F.concat(F.lit("SRX"), "o_orderkey").alias("experiment_accession"), (F.col("o_orderkey") % 2 == 0).alias("complete")
    )
    return bd.fetch_plan(requested_experiments(t), complete, index)


@query(
    "experiments_with_runs",
    "SELECT DISTINCT 'SRX' || l_orderkey AS experiment_accession FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 6",
)
def experiments_with_runs(t: Tables) -> DataFrame:
    """Experiments that contain a requested run."""
    runs = t.lineitem.filter("l_linenumber = 6").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Run"))
    return bd.experiments_with_runs(packages_of(t), runs)


@query(
    "linked_biosamples",
    f"""WITH {SQL_BUNDLE} SELECT accession, min(src) AS source FROM (SELECT biosample AS accession, 0 AS src FROM samples WHERE biosample IS NOT NULL
    UNION ALL SELECT 'SAMN' || s_suppkey, 1 FROM supplier) GROUP BY accession""",
)
def linked_biosamples(t: Tables) -> DataFrame:
    """BioSamples of samples and catalog."""
    catalog = t.supplier.select(F.concat(F.lit("SAMN"), "s_suppkey").alias("BioSample"), F.col("s_suppkey").alias(ORD))
    linked = bd.linked_biosamples(bundle_of(t).sra_samples, catalog)
    return linked.select("accession", F.col(f"{ORD}._src").alias("source"))


def _customer_halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    customers = t.customer.select(
        F.col("c_custkey").alias("accession"), "c_name", "c_acctbal", F.col("c_custkey").alias(ORD)
    )
    old = customers.filter("accession % 3 <> 0")
    new = customers.filter("accession % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return old, new


@query(
    "first_wins_union",
    "SELECT c_custkey AS accession, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0",
)
def first_wins_union(t: Tables) -> DataFrame:
    """Union where the first record of an accession stays."""
    return union_first_wins(*_customer_halves(t), "accession").drop(ORD)


@query(
    "last_wins_upsert",
    "SELECT c_custkey AS accession, c_name, CASE WHEN c_custkey % 2 <> 0 THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0",
)
def last_wins_upsert(t: Tables) -> DataFrame:
    """Upsert where the new record of an accession replaces the old one."""
    return upsert_last_wins(*_customer_halves(t), "accession").drop(ORD)


@query(
    "distinct_raw_records",
    "SELECT min(doc_id) AS first_doc, sha256(text) AS digest, CAST(count(*) AS BIGINT) AS copies FROM documents GROUP BY text",
)
def distinct_raw_records(t: Tables) -> DataFrame:
    """Records distinct by content, with the first position."""
    raw = t.documents.select(F.col("text").alias("raw"), "doc_id")
    keyed = raw.select("doc_id", bd.raw_identity(F.col("raw")).alias("digest"))
    return keyed.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"))


@query(
    "accession_unique_orders",
    """SELECT accession, o_totalprice FROM (SELECT 'A' || o_custkey AS accession, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
    FROM orders WHERE o_custkey % 10 <> 0) WHERE rn = 1""",
)
def accession_unique_orders(t: Tables) -> DataFrame:
    """First record per accession; blank accessions drop."""
    rows = t.orders.select(
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("A"), "o_custkey")).otherwise(F.lit("")).alias("accession"),
        "o_totalprice",
        F.col("o_orderkey").alias(ORD),
    )
    return bd.accession_unique(rows).drop(ORD)


@query(
    "disagreeing_records",
    "SELECT CAST(o_custkey AS VARCHAR) AS key FROM orders GROUP BY o_custkey HAVING min(o_orderstatus || o_orderpriority) <> max(o_orderstatus || o_orderpriority)",
)
def disagreeing_records(t: Tables) -> DataFrame:
    """Keys whose repeated records are not identical."""
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    return bd.agreement_violations(rows, ["o_custkey"], "orders").select("key")


@query(
    "completeness_index",
    f"""WITH {SQL_BUNDLE}, {SQL_COMPLETE} SELECT p.experiment_accession, p.sra_sample_accession AS sra_sample, s.biosample, c.experiment_accession IS NOT NULL AS complete,
      c.experiment_accession IS NOT NULL AND c.c_nationkey < {RAW_NATIONS} AS raw_available
    FROM packages p LEFT JOIN samples s ON s.accession = p.sra_sample_accession LEFT JOIN complete c ON c.experiment_accession = p.experiment_accession""",
)
def completeness_index(t: Tables) -> DataFrame:
    """Completeness of every experiment."""
    return bundle_of(t, with_runs=False).completeness_index()


ALIAS_ROWS = ", ".join(
    f"('{alias}', '{output}')" for output, names in ds.FIELD_ALIASES.items() for alias in names
)
ATTRIBUTE_NAMES = ("cell_type", "Dev_Stage", "genotype/variation", "collection_date", "External Id", "tissue-type", "unknown mechanism")
_NAME_SQL = "CASE doc_id % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(ATTRIBUTE_NAMES)) + " END"


@query(
    "selected_attributes",
    f"""WITH aliases(alias, built_in) AS (VALUES {ALIAS_ROWS}), N AS (SELECT doc_id, {_NAME_SQL} AS name,
      CASE doc_id % 3 WHEN 0 THEN 'biosample' WHEN 1 THEN 'experiment' ELSE 'study' END AS source FROM documents),
    M AS (SELECT N.*, CASE WHEN name = 'unknown mechanism' THEN 'Mechanism' ELSE built_in END AS found FROM N
      LEFT JOIN aliases ON alias = lower(regexp_replace(name, '[_/-]+', ' ', 'g')))
    SELECT doc_id, CASE source WHEN 'experiment' THEN name WHEN 'biosample' THEN found END AS output,
      CASE WHEN source = 'experiment' THEN '{ds.KEEP_EXPERIMENT}' WHEN source = 'study' THEN '{ds.OMIT_OTHER}'
           WHEN found IS NULL THEN '{ds.OMIT_SAMPLE}' ELSE '{ds.KEEP_SAMPLE}' END AS reason FROM M""",
)
def selected_attributes(t: Tables) -> DataFrame:
    """Output field and reason of attribute names, with a caller's alias."""
    name = F.element_at(F.array(*[F.lit(n) for n in ATTRIBUTE_NAMES]), (F.col("doc_id") % 7 + 1).cast("int"))
    source = F.when(F.col("doc_id") % 3 == 0, "biosample").when(F.col("doc_id") % 3 == 1, "experiment").otherwise("study")
    rows = t.documents.select("doc_id", name.alias("name"), source.alias("source"))
    policy = ds.DescriptionPolicy({"Unknown_Mechanism": "Mechanism"})
    return ds.select_attributes(rows, policy.alias_table(t.spark)).select("doc_id", "output", "reason")


_TISSUE = "CASE WHEN role = 'user' THEN 'Tissue' ELSE role END"


@query(
    "folded_attributes",
    f"""WITH V AS (SELECT conv_id, turn, {_TISSUE} AS field, unnest([CASE WHEN turn % 3 = 0 THEN '[' || role || '] ' || text WHEN turn % 3 = 1 THEN text || '  ' ELSE text END, 'Not  Provided']) AS value
      FROM conversations),
    K AS (SELECT *, CASE WHEN field = 'Tissue' THEN lower(regexp_replace(trim(regexp_replace(value, '\\s+', ' ', 'g')), '^[[][^]]+[]] *', '')) ELSE trim(regexp_replace(value, '\\s+', ' ', 'g')) END AS cmp
      FROM V WHERE lower(trim(regexp_replace(value, '\\s+', ' ', 'g'))) <> 'not provided')
    SELECT conv_id, field, arg_min(value, turn) AS value, CAST(min(turn) AS BIGINT) AS first_turn FROM K GROUP BY conv_id, field, cmp""",
)
def folded_attributes(t: Tables) -> DataFrame:
    """The texts of each role in a conversation, without placeholders and equivalent copies."""
    text = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("["), "role", F.lit("] "), "text"))
        .when(F.col("turn") % 3 == 1, F.concat("text", F.lit("  ")))
        .otherwise(F.col("text"))
    )
    rows = t.conversations.select(
        "conv_id",
        F.when(F.col("role") == "user", F.lit("Tissue")).otherwise(F.col("role")).alias("field"),
        F.explode(F.array(text, F.lit("Not  Provided"))).alias("value"),
        F.col("turn").alias("ord"),
        F.lit(False).alias("keep_missing"),
    )
    return ds.fold_values(rows, ["conv_id"]).select("conv_id", "field", "value", F.col("ord").cast("bigint").alias("first_turn"))


@query(
    "experiment_wins",
    """WITH R AS (SELECT conv_id, role AS field, turn % 2 AS stage, turn, text AS value FROM conversations),
    H AS (SELECT conv_id, field, max(stage) AS stage FROM R GROUP BY conv_id, field)
    SELECT R.conv_id, R.field, CAST(R.turn AS BIGINT) AS turn, md5(R.value) AS value_md5 FROM R JOIN H USING (conv_id, field, stage)""",
)
def experiment_wins(t: Tables) -> DataFrame:
    """Experiment values replace sample values of the same field."""
    rows = t.conversations.select(
        "conv_id", F.col("role").alias("field"), (F.col("turn") % 2).alias("stage"), F.col("turn").alias("ord"), F.col("text").alias("value")
    )
    kept = ds.experiment_wins(rows, ["conv_id"])
    return kept.select("conv_id", "field", F.col("ord").cast("bigint").alias("turn"), F.md5("value").alias("value_md5"))


_FIELD_ROWS = """
F AS (
  SELECT experiment, 'ID' AS field, experiment AS value, 0 AS stage FROM L UNION ALL SELECT experiment, 'Experiment ID', experiment, 0 FROM L
  UNION ALL SELECT experiment, 'SRA Sample ID', sample, 0 FROM L UNION ALL SELECT experiment, 'BioSample ID', biosample, 0 FROM L WHERE biosample IS NOT NULL
  UNION ALL SELECT experiment, 'Species', organism, 0 FROM L WHERE organism IS NOT NULL
  UNION ALL SELECT experiment, 'Sex', 'female', 0 FROM L WHERE has_biosample
  UNION ALL SELECT experiment, 'Tissue', '[src] ' || upper(left(seg, 1)) || substr(lower(seg), 2), 0 FROM L WHERE seg IS NOT NULL AND NOT (has_experiment AND ok % 4 = 0)
  UNION ALL SELECT experiment, 'Tissue', 'assay tissue', 1 FROM L WHERE has_experiment AND ok % 4 = 0
  UNION ALL SELECT experiment, 'Source name', lower(seg), 0 FROM L WHERE seg IS NOT NULL AND has_experiment AND ok % 4 = 0
  UNION ALL SELECT experiment, 'Age', (ck % 90) || ' years', 0 FROM L WHERE seg IS NOT NULL
  UNION ALL SELECT experiment, 'Disease', 'none seen', 0 FROM L WHERE seg IS NOT NULL AND ck % 3 <> 0
  UNION ALL SELECT experiment, 'Sample description', 'from ' || nation, 0 FROM L WHERE has_biosample
  UNION ALL SELECT * FROM E)"""
_STUDY_ROWS = """
E AS (
  SELECT experiment, 'Design' AS field, design AS value, 1 AS stage FROM L WHERE has_experiment UNION ALL SELECT experiment, 'Strategy', strategy, 1 FROM L WHERE has_experiment
  UNION ALL SELECT experiment, 'Source', 'GENOMIC', 1 FROM L WHERE has_experiment UNION ALL SELECT experiment, 'Selection', '', 1 FROM L WHERE has_experiment
  UNION ALL SELECT experiment, 'Layout', layout, 1 FROM L WHERE has_experiment UNION ALL SELECT experiment, 'Insert size', '300', 1 FROM L WHERE has_experiment
  UNION ALL SELECT experiment, 'Study', study, 1 FROM L UNION ALL SELECT experiment, 'Abstract', abstract, 1 FROM L
  UNION ALL SELECT experiment, 'Submitted by', submitter || ' (GEO)', 1 FROM L WHERE submitter IS NOT NULL)"""
_LINKED = f"""{SQL_BUNDLE}, L AS (SELECT p.experiment_accession AS experiment, p.sra_sample_accession AS sample, p.o_orderkey AS ok, s.biosample, s.organism, s.c_mktsegment AS seg, s.c_custkey AS ck,
  b.accession IS NOT NULL AS has_biosample, b.title AS nation, e.accession IS NOT NULL AS has_experiment, e.design_description AS design, e.strategy, e.layout, t.title AS study, t.abstract, u.r_name AS submitter
  FROM packages p LEFT JOIN samples s ON s.accession = p.sra_sample_accession LEFT JOIN biosamples b ON b.accession = s.biosample LEFT JOIN experiments e ON e.accession = p.experiment_accession
  LEFT JOIN studies t ON t.accession = p.study_accession LEFT JOIN submissions u ON u.accession = p.submission_accession)"""


@query(
    "study_fields",
    f"""WITH {_LINKED}, {_STUDY_ROWS} SELECT experiment, field, value FROM E
    UNION ALL SELECT experiment, 'Tissue', 'assay tissue' FROM L WHERE has_experiment AND ok % 4 = 0""",
)
def study_fields(t: Tables) -> DataFrame:
    """Library and study fields per experiment."""
    return ds.study_fields(bundle_of(t, with_runs=False), strict=False).select("experiment", "field", "value")


@query("compact_descriptions", f"WITH {_LINKED}, {_STUDY_ROWS}, {_FIELD_ROWS} SELECT experiment, field, value FROM F")
def compact_descriptions(t: Tables) -> DataFrame:
    """Sample, library and study fields per experiment."""
    return ds.compact_descriptions(bundle_of(t, with_runs=False), strict=False).select("experiment", "field", "value")


@query("description_fields", f"WITH {_LINKED}, {_STUDY_ROWS}, {_FIELD_ROWS} SELECT experiment, string_agg(DISTINCT field, '|' ORDER BY field) AS fields FROM F GROUP BY experiment")
def description_fields(t: Tables) -> DataFrame:
    """Field names of the packed description of every experiment."""
    maps = ds.compact_maps(bundle_of(t, with_runs=False), strict=False)
    return maps.select("experiment", F.array_join(F.array_sort(F.map_keys("description")), "|").alias("fields"))


def report_table(t: Tables) -> DataFrame:
    """Parts as assembly reports in JSON."""
    level = F.element_at(
        F.array(*[F.lit(x) for x in ("Contig", "Scaffold", "Chromosome", "Complete Genome")]), (F.col("p_partkey") % 4 + 1).cast("int")
    )
    report = F.to_json(
        F.struct(
            F.concat(F.lit("GCF_"), F.col("p_partkey")).alias("accession"),
            F.struct(
                F.regexp_extract("p_brand", "[0-9]+", 0).cast("bigint").alias("tax_id"), F.col("p_brand").alias("organism_name")
            ).alias("organism"),
            F.when(F.col("p_partkey") % 3 == 0, "SOURCE_DATABASE_REFSEQ").otherwise("").alias("source_database"),
            F.struct(
                F.when(F.col("p_partkey") % 17 == 0, "suppressed").otherwise("current").alias("assembly_status"),
                F.when(F.col("p_type") == "PROMO", "reference genome").when(F.col("p_type") == "LARGE", "representative genome").alias("refseq_category"),
                level.alias("assembly_level"),
                F.concat(F.lit("20"), F.lpad((F.col("p_partkey") % 20).cast("string"), 2, "0"), F.lit("-01-01")).alias("release_date"),
                F.when(F.col("p_partkey") % 19 == 0, F.array(F.lit("Marked ATYPICAL: x"))).alias("warnings"),
            ).alias("assembly_info"),
            F.struct(
                F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(0).alias("scaffold_n50"),
                F.col("p_size").alias("contig_n50"),
                F.floor("p_retailprice").cast("string").alias("total_sequence_length"),
            ).alias("assembly_stats"),
        )
    )
    return t.part.select(
        report.alias("report"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("bigint").alias("requested_taxid"),
        F.col("p_partkey").alias(ORD),
    )


SQL_CANDIDATES = """
candidates AS (SELECT 'GCF_' || p_partkey AS accession, CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS taxid, p_brand AS scientific_name,
  CASE WHEN p_partkey % 3 = 0 THEN 'SOURCE_DATABASE_REFSEQ' END AS source_database, CASE WHEN p_partkey % 17 = 0 THEN 'suppressed' ELSE 'current' END AS assembly_status,
  CASE p_type WHEN 'PROMO' THEN 'reference genome' WHEN 'LARGE' THEN 'representative genome' END AS refseq_category, CAST(p_partkey % 4 + 1 AS INTEGER) AS level,
  ['Contig', 'Scaffold', 'Chromosome', 'Complete Genome'][CAST(p_partkey % 4 + 1 AS INTEGER)] AS assembly_level, '20' || lpad(CAST(p_partkey % 20 AS VARCHAR), 2, '0') || '-01-01' AS release_date,
  CASE WHEN p_size > 25 THEN p_size ELSE 0 END AS scaffold_n50, p_size AS contig_n50, CAST(floor(p_retailprice) AS BIGINT) AS total_length, p_partkey % 19 = 0 AS atypical, p_partkey FROM part)
"""


def candidate_table(t: Tables) -> DataFrame:
    """Candidates read from the reports."""
    return gn.candidates_from_reports(report_table(t), "requested_taxid", ORD)


@query(
    "assembly_candidates",
    f"""WITH {SQL_CANDIDATES} SELECT accession, taxid, scientific_name, source_database, assembly_status, refseq_category, assembly_level, release_date,
    scaffold_n50, contig_n50, total_length, atypical, CASE WHEN atypical THEN 'Marked ATYPICAL: x' ELSE '' END AS warnings FROM candidates""",
)
def assembly_candidates(t: Tables) -> DataFrame:
    """Candidate columns from JSON reports."""
    return candidate_table(t).select(
        "accession", "taxid", "scientific_name", "source_database", "assembly_status", "refseq_category", "assembly_level",
        "release_date", "scaffold_n50", "contig_n50", "total_length", "atypical", F.array_join("warnings", ";").alias("warnings"),
    )


def genome_requests(t: Tables) -> DataFrame:
    """One request per brand; some brands pin an assembly, and one brand is unknown."""
    brands = t.part.groupBy(F.regexp_extract("p_brand", "[0-9]+", 0).cast("bigint").alias("requested_taxid")).agg(
        F.min("p_partkey").alias("first"), F.max("p_partkey").alias("last")
    )
    pin = (
        F.when(F.col("requested_taxid") % 5 == 0, F.concat(F.lit("GCF_"), "first"))
        .when(F.col("requested_taxid") % 7 == 0, F.concat(F.lit("GCF_none"), "last"))
        .otherwise(F.lit(""))
    )
    unknown = t.region.select((F.col("r_regionkey") + 900).cast("bigint").alias("requested_taxid"), F.lit(None).cast("string").alias("pin"))
    return brands.select("requested_taxid", pin.alias("pin")).unionByName(unknown)


SQL_REQUESTS = """requests AS (SELECT requested_taxid, CASE WHEN requested_taxid % 5 = 0 THEN 'GCF_' || f WHEN requested_taxid % 7 = 0 THEN 'GCF_none' || l END AS pin FROM
  (SELECT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS requested_taxid, min(p_partkey) AS f, max(p_partkey) AS l FROM part GROUP BY 1)
  UNION ALL SELECT CAST(r_regionkey + 900 AS BIGINT), NULL FROM region),
ranked AS (SELECT r.requested_taxid, r.pin, c.*, row_number() OVER (PARTITION BY r.requested_taxid ORDER BY
  CASE WHEN refseq_category LIKE '%reference%' THEN 2 WHEN refseq_category LIKE '%representative%' THEN 1 ELSE 0 END DESC, (source_database IS NOT NULL) DESC, level DESC,
  coalesce(nullif(scaffold_n50, 0), nullif(contig_n50, 0), 0) DESC, total_length DESC, release_date DESC, accession DESC) AS rn
  FROM requests r JOIN candidates c ON c.taxid = r.requested_taxid
  WHERE CASE WHEN r.pin IS NOT NULL THEN c.accession = r.pin ELSE assembly_status = 'current' AND NOT atypical AND level >= 2 END)"""
POLICY = gn.GenomeSelectionPolicy(minimum_assembly_level="Scaffold")


@query(
    "selected_genomes",
    f"""WITH {SQL_CANDIDATES}, {SQL_REQUESTS} SELECT requested_taxid, pin, accession, assembly_level,
    'exact species taxid: ' || taxid || '|assembly status: ' || assembly_status || '|RefSeq category: ' || coalesce(refseq_category, 'none') || '|source database: ' || coalesce(source_database, 'unspecified')
    || '|assembly level: ' || assembly_level || '|scaffold/contig N50: ' || coalesce(nullif(scaffold_n50, 0), contig_n50) || '|release date tie-breaker: ' || release_date AS rationale
    FROM ranked WHERE rn = 1""",
)
def selected_genomes(t: Tables) -> DataFrame:
    """Best or pinned assembly per species with the reasons."""
    chosen, _ = gn.select_genomes(gn.distinct_candidates(candidate_table(t), "requested_taxid"), genome_requests(t), POLICY)
    return chosen.select(
        "requested_taxid", "pin", "accession", "assembly_level", F.array_join("selection_rationale", "|").alias("rationale")
    )


@query(
    "unserved_genome_requests",
    f"""WITH {SQL_CANDIDATES}, {SQL_REQUESTS} SELECT CAST(requested_taxid AS VARCHAR) AS key,
    CASE WHEN pin IS NOT NULL THEN 'pinned genome ' || pin || ' was not reported' ELSE 'no assembly satisfies the policy' END AS detail
    FROM requests WHERE requested_taxid NOT IN (SELECT requested_taxid FROM ranked)""",
)
def unserved_genome_requests(t: Tables) -> DataFrame:
    """Requests without an acceptable assembly."""
    _, problems = gn.select_genomes(candidate_table(t), genome_requests(t), POLICY)
    return problems.select("key", "detail")


@query(
    "distinct_candidates",
    f"""WITH {SQL_CANDIDATES}, D AS (SELECT *, 0 AS copy FROM candidates UNION ALL SELECT * REPLACE ('again' AS scientific_name), 1 FROM candidates WHERE taxid % 2 = 0)
    SELECT accession, arg_max(scientific_name, copy) AS scientific_name FROM D GROUP BY accession""",
)
def distinct_candidates(t: Tables) -> DataFrame:
    """Last report per accession."""
    once = candidate_table(t).select("accession", "scientific_name", "taxid", F.struct(F.lit(0).alias("copy"), ORD).alias(ORD))
    again = once.filter("taxid % 2 = 0").withColumn("scientific_name", F.lit("again")).withColumn(
        ORD, F.struct(F.lit(1).alias("copy"), F.col(f"{ORD}.{ORD}").alias(ORD))
    )
    return gn.distinct_candidates(once.unionByName(again)).select("accession", "scientific_name")


def genome_table(t: Tables, *, moved: bool = False) -> DataFrame:
    """Nations as registered genomes."""
    return t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("taxid"),
        F.col("n_name").alias("scientific_name"),
        F.concat(F.lit("GCF_"), F.col("n_nationkey") + (100 if moved else 0)).alias("accession"),
        F.concat(F.lit("/genomes/"), "n_name", F.lit(".fa")).alias("fasta"),
        F.sha2("n_name", 256).alias("sha256"),
        F.col("n_nationkey").alias(ORD),
    )


@query(
    "registered_genomes",
    """SELECT CAST(n_nationkey AS BIGINT) AS taxid, 'GCF_' || CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 100 ELSE n_nationkey END AS accession, n_nationkey AS position FROM nation""",
)
def registered_genomes(t: Tables) -> DataFrame:
    """Genomes after re-registering every second species."""
    merged = gn.upsert_genomes(genome_table(t), genome_table(t, moved=True).filter("taxid % 2 = 0"))
    return merged.select("taxid", "accession", F.col(ORD).alias("position"))


@query(
    "genome_cache",
    """WITH Q AS (SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS taxid, CASE WHEN s_nationkey % 4 = 1 THEN 'GCF_other' WHEN s_nationkey % 4 = 2 THEN 'GCF_' || s_nationkey END AS pin FROM supplier)
    SELECT taxid, pin, (pin IS NULL OR pin = 'GCF_' || taxid) AND taxid % 3 <> 0 AND taxid % 5 <> 0 AS cached FROM Q""",
)
def genome_cache(t: Tables) -> DataFrame:
    """Whether each required genome is registered and intact."""
    pin = F.when(F.col("s_nationkey") % 4 == 1, "GCF_other").when(F.col("s_nationkey") % 4 == 2, F.concat(F.lit("GCF_"), "s_nationkey"))
    required = t.supplier.select(F.col("s_nationkey").cast("bigint").alias("taxid"), pin.alias("pin"))
    files = genome_table(t).select(
        F.col("fasta").alias("path"),
        F.when(F.col("taxid") % 3 == 0, 0).otherwise(10).alias("size"),
        F.when(F.col("taxid") % 5 == 0, "broken").otherwise(F.col("sha256")).alias("sha256"),
    )
    return gn.cache_inventory(required, genome_table(t), files).select("taxid", "pin", "cached")


@query(
    "latest_customer_order",
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey",
)
def latest_customer_order(t: Tables) -> DataFrame:
    """Keep-last per key, through the reversed order."""
    rows = with_order(t.orders.select("o_custkey", "o_orderkey"), "o_orderkey")
    return keep_first(rows, ["o_custkey"], -F.col("o_orderkey")).drop(ORD)
