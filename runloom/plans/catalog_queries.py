"""Catalog, unit and fingerprint queries on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import lenient_float
from ..operators import catalog as cat
from ..operators import units as un
from ..operators.manifest import items_digest
from ..operators.reads import oversized_runs
from ..ordering import ORD, keep_first, with_order
from .registry import Tables, query

ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")

# A name that only equal lines share, so that no line of the table contradicts another.
WHOLE_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
_WHOLE_SQL = " || '-' || ".join(
    [f"CAST({c} AS VARCHAR)" for c in WHOLE_LINE] + [f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" for c in ("l_quantity", "l_extendedprice")]
)


def _sql_c(run: str, more: str = "") -> str:
    return f"""
C AS (
  SELECT {run} AS Run,{more}
         'SRX' || CAST(l_orderkey AS VARCHAR) AS Experiment,
         'SRS' || CAST(l_partkey AS VARCHAR) AS Sample,
         'SAMN' || CAST(l_suppkey AS VARCHAR) AS BioSample,
         CAST(s_nationkey AS BIGINT) AS TaxID, n_name AS ScientificName,
         l_quantity AS bases, l_extendedprice AS size_MB,
         l_returnflag AS LibraryStrategy, l_linestatus AS LibraryLayout,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""


SQL_C = _sql_c("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)")
CONFLICT_COLUMNS = ("Experiment", "Sample", "BioSample", "TaxID", "ScientificName", "bases", "size_MB", "LibraryStrategy", "LibraryLayout")
_ORDER_SQL = ", ".join(ORDER)
SQL_CLEAN = (
    _sql_c(_WHOLE_SQL)
    + ", K AS (SELECT Run FROM C GROUP BY Run HAVING "
    + " AND ".join(f"min({c}) = max({c})" for c in CONFLICT_COLUMNS)
    + "), R AS (SELECT C.*, row_number() OVER (PARTITION BY Run ORDER BY "
    + _ORDER_SQL
    + ") AS rn FROM C SEMI JOIN K USING (Run)), CC AS (SELECT * FROM R WHERE rn = 1)"
)
# Runs are named by order and line. Copies that agree are one run; each copy of a run that
# contradicts itself is a run of its own, named by its whole line.
SQL_APART = (
    _sql_c("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", f" {_WHOLE_SQL} AS Own,")
    + ", K AS (SELECT Run FROM C GROUP BY Run HAVING "
    + " OR ".join(f"min({c}) <> max({c})" for c in CONFLICT_COLUMNS)
    + "), N AS (SELECT C.* REPLACE (CASE WHEN Run IN (SELECT Run FROM K) THEN Own ELSE Run END AS Run) FROM C)"
    + f", R AS (SELECT *, row_number() OVER (PARTITION BY Run ORDER BY {_ORDER_SQL}) AS rn FROM N), CC AS (SELECT * FROM R WHERE rn = 1)"
)
_CONFLICT_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN min({c}) <> max({c}) THEN '{c}' END" for c in CONFLICT_COLUMNS
) + ")"


def catalog_view(t: Tables, run: Column | None = None) -> DataFrame:
    """The line items as a run table; see ``SQL_C`` for the same view in SQL."""
    joined = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        (F.concat_ws("-", "l_orderkey", "l_linenumber") if run is None else run).alias("Run"),
        F.concat(F.lit("SRX"), F.col("l_orderkey")).alias("Experiment"),
        F.concat(F.lit("SRS"), F.col("l_partkey")).alias("Sample"),
        F.concat(F.lit("SAMN"), F.col("l_suppkey")).alias("BioSample"),
        F.col("s_nationkey").cast("bigint").alias("TaxID"),
        F.col("n_name").alias("ScientificName"),
        F.col("l_quantity").alias("bases"),
        F.col("l_extendedprice").alias("size_MB"),
        F.col("l_returnflag").alias("LibraryStrategy"),
        F.col("l_linestatus").alias("LibraryLayout"),
        F.struct(*ORDER).alias(ORD),
    )


def clean_catalog(t: Tables) -> DataFrame:
    """The run table of all lines, equal ones merged; no run contradicts itself."""
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("l_quantity", "l_extendedprice")]
    return cat.without_conflicts(cat.merge_few_duplicates(catalog_view(t, F.concat_ws("-", *WHOLE_LINE, *cents))))


def whole_catalog(t: Tables) -> DataFrame:
    """The run table of all lines by run accession; see ``SQL_APART`` for the same table in SQL."""
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("bases", "size_MB")]
    keys = [F.col(ORD)[c] for c in ("l_partkey", "l_suppkey")]
    own = F.concat_ws("-", "Run", *keys, "LibraryStrategy", "LibraryLayout", *cents)
    return cat.merge_or_keep_apart(catalog_view(t), own)


@query(
    "run_conflicts",
    f"WITH {SQL_C} SELECT Run AS key, {_CONFLICT_LIST} AS detail FROM C GROUP BY Run HAVING {_CONFLICT_LIST} <> ''",
)
def run_conflicts(t: Tables) -> DataFrame:
    """Duplicate runs with contradicting columns."""
    return cat.conflict_rows(cat.contradictions(catalog_view(t))).select("key", "detail")


@query(
    "first_run_conflicts",
    f"""WITH {SQL_C}, F AS (SELECT Run, row_number() OVER (ORDER BY {_ORDER_SQL}) AS n FROM C),
    G AS (SELECT Run, min(n) AS n FROM F GROUP BY Run)
    SELECT Run, columns FROM (SELECT Run, {_CONFLICT_LIST} AS columns FROM C GROUP BY Run HAVING {_CONFLICT_LIST} <> '')
    JOIN G USING (Run) ORDER BY n LIMIT 10""",
)
def first_run_conflicts(t: Tables) -> DataFrame:
    """The ten conflicts an error report names."""
    return cat.first_contradictions(catalog_view(t))


@query(
    "merged_orders",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def merged_orders(t: Tables) -> DataFrame:
    """Two half-empty copies of every order merge back into the order."""
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = t.orders.select("o_orderkey", *columns, F.col("o_orderkey").alias(ORD))
    kinds = dict(orders.dtypes)

    def half(kept: set) -> DataFrame:
        return orders.select(
            "o_orderkey",
            *[F.col(c) if c in kept else F.lit(None).cast(kinds[c]).alias(c) for c in columns],
            ORD,
        )

    both = half(set(columns[:2])).unionByName(half(set(columns[2:])))
    return cat.without_conflicts(cat.merge_duplicates(both, "o_orderkey")).drop(ORD)


@query(
    "filtered_catalog",
    f"""WITH {SQL_C} SELECT Run, BioSample, round(size_MB / 1000, 9) AS size_gb, bases * 2 AS doubled
    FROM C WHERE LibraryStrategy = 'R' AND size_MB > 50000 AND TaxID < 10""",
)
def filtered_catalog(t: Tables) -> DataFrame:
    """Column filters, added columns, a table function and a selection."""
    catalog = cat.RunCatalog(catalog_view(t))
    result = (
        catalog.filter(F.col("LibraryStrategy") == "R", description="strategy R")
        .filter("size_MB > 50000")
        .with_columns(size_gb=F.round(lenient_float(F.col("size_MB")) / 1000, 9))
        .transform(lambda df: df.filter("TaxID < 10").withColumn("doubled", F.col("bases") * 2))
        .select("BioSample", "size_gb", "doubled")
    )
    return result.frame.drop(ORD)


@query(
    "row_filtered_catalog",
    f"WITH {SQL_C} SELECT Run, Experiment, bases FROM C WHERE bases >= 40 AND LibraryLayout = 'O'",
)
def row_filtered_catalog(t: Tables) -> DataFrame:
    """A row function as filter, run in Arrow batches."""
    catalog = cat.RunCatalog(catalog_view(t)).select("Run", "Experiment", "bases", "LibraryLayout")
    kept = catalog.filter(lambda row: row["bases"] >= 40 and row["LibraryLayout"] == "O", description="long open")
    return kept.frame.select("Run", "Experiment", "bases")


@query(
    "catalog_audit",
    f"""WITH {SQL_C}, N AS (SELECT count(*) AS a, count(*) FILTER (TaxID < 10) AS b,
      count(*) FILTER (TaxID < 10 AND bases > 25) AS c FROM C)
    SELECT 0 AS step, 'created from tables' AS event FROM N
    UNION ALL SELECT 1, 'filter low taxids: ' || a || ' -> ' || b || ' rows' FROM N
    UNION ALL SELECT 2, 'transform large: ' || b || ' -> ' || c || ' rows' FROM N""",
)
def catalog_audit(t: Tables) -> DataFrame:
    """Audit trail with row counts, measured in one pass."""
    catalog = cat.RunCatalog(catalog_view(t), audit=("created from tables",))
    kept = catalog.filter("TaxID < 10", description="low taxids").transform(
        lambda df: df.filter("bases > 25"), description="large"
    )
    return kept.audit_table()


@query(
    "unit_summaries",
    f"""WITH {SQL_APART} SELECT BioSample AS unit_id, min(ScientificName) AS scientific_name, min(TaxID) AS taxid,
    CAST(sum(CAST(trunc(bases) AS BIGINT)) AS BIGINT) AS total_bases,
    round(CAST(sum(CAST(size_MB AS DECIMAL(28,9))) AS DOUBLE) / 1000, 6) AS total_size_gb
    FROM CC GROUP BY BioSample""",
)
def unit_summaries(t: Tables) -> DataFrame:
    """Units by BioSample."""
    table = un.group_units(whole_catalog(t), "BioSample", unique_runs=True).table
    return table.drop(ORD).withColumn("total_size_gb", F.round("total_size_gb", 6))


MEMBER_SQL = {
    "run_accessions": "Run",
    "experiment_accessions": "Experiment",
    "sra_sample_accessions": "Sample",
    "biosample_accessions": "BioSample",
    "library_strategy": "LibraryStrategy",
    "library_layout": "LibraryLayout",
}


def _members_sql(unit: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {unit} AS unit_id, '{kind}' AS kind, {column} AS value, {_ORDER_SQL} FROM CC" for kind, column in MEMBER_SQL.items()
    )


@query(
    "unit_members",
    f"""WITH {SQL_APART}, U AS ({_members_sql("BioSample")}),
    V AS (SELECT *, row_number() OVER (PARTITION BY unit_id, kind, value ORDER BY {_ORDER_SQL}) AS rn FROM U)
    SELECT unit_id, kind, value, l_orderkey AS first_order, l_linenumber AS first_line FROM V WHERE rn = 1""",
)
def unit_members(t: Tables) -> DataFrame:
    """Distinct list values per unit with their first appearance."""
    # The first by the whole order begins with the first order and line, all that is returned.
    catalog = whole_catalog(t).withColumn(ORD, F.struct(f"{ORD}.l_orderkey", f"{ORD}.l_linenumber"))
    members = un.unit_members(catalog, "BioSample", unique_runs=True)
    return members.select(
        "unit_id",
        "kind",
        "value",
        F.col(f"{ORD}.l_orderkey").alias("first_order"),
        F.col(f"{ORD}.l_linenumber").alias("first_line"),
    )


@query(
    "unit_species_conflicts",
    f"""WITH {SQL_APART} SELECT Experiment AS key,
    'taxids ' || min(TaxID) || '..' || max(TaxID) || ', names ' || min(ScientificName) || '..' || max(ScientificName) AS detail
    FROM CC GROUP BY Experiment HAVING min(TaxID) <> max(TaxID) OR min(ScientificName) <> max(ScientificName)""",
)
def unit_species_conflicts(t: Tables) -> DataFrame:
    """Experiments that mix species."""
    return un.group_units(whole_catalog(t), "Experiment", unique_runs=True).violations.select("key", "detail")


@query(
    "unit_run_sizes",
    f"WITH {SQL_APART} SELECT BioSample AS unit_id, Run AS run, round(size_MB / 1000, 9) AS size_gb FROM CC",
)
def unit_run_sizes(t: Tables) -> DataFrame:
    """Size per unit and run."""
    sizes = un.unit_run_sizes(whole_catalog(t), "BioSample", unique_runs=True)
    return sizes.withColumn("size_gb", F.round("size_gb", 9))


@query(
    "oversized_runs",
    f"""WITH {SQL_APART}, S AS (SELECT *, (CAST(round(size_MB * 100) AS BIGINT) + 50) // 100 AS thousandths FROM CC)
    SELECT BioSample AS key, Run || '=' || (thousandths // 1000) || '.' || lpad(CAST(thousandths % 1000 AS VARCHAR), 3, '0') || ' GB' AS detail
    FROM S WHERE size_MB / 1000 > 90""",
)
def oversized(t: Tables) -> DataFrame:
    """Runs above a size setting."""
    return oversized_runs(un.unit_run_sizes(whole_catalog(t), "BioSample", unique_runs=True), "90G").select("key", "detail")


@query(
    "packed_experiment_lists",
    f"""WITH {SQL_CLEAN}, U AS ({_members_sql("Experiment")}),
    V AS (SELECT *, row_number() OVER (PARTITION BY unit_id, kind, value ORDER BY {_ORDER_SQL}) AS rn FROM U)
    SELECT unit_id, kind, string_agg(value, ',' ORDER BY {_ORDER_SQL}, value) AS listed, 1 AS n_chunks FROM V WHERE rn = 1 GROUP BY unit_id, kind""",
)
def packed_experiment_lists(t: Tables) -> DataFrame:
    """Ordered arrays per experiment, in bounded chunks."""
    packed = un.packed_members(clean_catalog(t), "Experiment", unique_runs=True)
    return packed.select("unit_id", "kind", F.array_join("values", ",").alias("listed"), "n_chunks")


@query(
    "first_filled_fields",
    """SELECT o_custkey,
    coalesce(arg_min(nullif(p, ''), o_orderkey) FILTER (nullif(p, '') IS NOT NULL), arg_min(o_orderstatus, o_orderkey)) AS label
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN NULL
          WHEN o_totalprice > 400000 THEN o_orderpriority END AS p FROM orders) GROUP BY o_custkey""",
)
def first_filled_fields(t: Tables) -> DataFrame:
    """First non-empty value of one column, else of the next."""
    orders = t.orders.withColumn(
        "p",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(""))
        .when(F.col("o_orderkey") % 3 == 1, F.lit(None))
        .when(F.col("o_totalprice") > 400000, F.col("o_orderpriority")),
    )
    return orders.groupBy("o_custkey").agg(un.first_filled("o_orderkey", "p", "o_orderstatus").alias("label"))


def _entity_sql(column: str) -> str:
    return f"""WITH {SQL_C}, V AS (SELECT *, row_number() OVER (PARTITION BY {column} ORDER BY {_ORDER_SQL}) AS rn FROM C)
    SELECT {column}, Run, TaxID, bases FROM V WHERE rn = 1"""


@query("entity_samples", _entity_sql("Sample"))
def entity_samples(t: Tables) -> DataFrame:
    """First run of every sample."""
    catalog = cat.RunCatalog(catalog_view(t)).select("Sample", "Run", "TaxID", "bases")
    return catalog.normalized_entities()["sra_samples"].select("Sample", "Run", "TaxID", "bases")


@query("entity_biosamples", _entity_sql("BioSample"))
def entity_biosamples(t: Tables) -> DataFrame:
    """First run of every BioSample."""
    catalog = cat.RunCatalog(catalog_view(t)).select("BioSample", "Run", "TaxID", "bases")
    return catalog.normalized_entities()["biosamples"].select("BioSample", "Run", "TaxID", "bases")


@query(
    "distinct_experiments",
    """SELECT Experiment, min(l_linenumber) AS first_line FROM (SELECT 'SRX' || l_orderkey AS Experiment, l_linenumber FROM lineitem) GROUP BY Experiment""",
)
def distinct_experiments(t: Tables) -> DataFrame:
    """Distinct experiments in order of first appearance."""
    keys = cat.distinct_keys(catalog_view(t), "Experiment")
    return keys.select("Experiment", F.col(f"{ORD}.l_linenumber").alias("first_line"))


PINS_SQL = "SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS taxid, 'GCF_' || n_nationkey AS accession FROM nation WHERE n_nationkey % 5 = 0"


def _set_sql(column: str) -> str:
    """JSON list with the text that identifies a set: its size and XOR-ed digests."""
    pieces = [
        f"lpad(lower(hex(bit_xor(DISTINCT ('0x' || substr(sha256({column}), {1 + 15 * i}, 15))::BIGINT))), 15, '0')" for i in range(4)
    ]
    return f"""CASE WHEN count({column}) = 0 THEN '[]' ELSE '["set:' || count(DISTINCT {column}) || ':' || {' || '.join(pieces)} || '"]' END"""


_PRINTS = f"""P AS ({PINS_SQL}),
L AS (SELECT BioSample AS unit_id, min(TaxID) AS taxid,
   {_set_sql('Run')} AS run_accessions, {_set_sql('Experiment')} AS experiment_accessions,
   {_set_sql('Sample')} AS sra_sample_accessions, {_set_sql('BioSample')} AS biosample_accessions
   FROM CC GROUP BY BioSample),
FP AS (SELECT unit_id, L.taxid, accession AS genome_pin, sha256(
   '{{"biosample_accessions":' || biosample_accessions || ',"description_identity":null'
   || ',"experiment_accessions":' || experiment_accessions || ',"fastq_identity":"archive"'
   || ',"genome_pin":' || coalesce('"' || accession || '"', 'null') || ',"group_by":"biosample","processor_identity":"demo:v1"'
   || ',"run_accessions":' || run_accessions
   || ',"sra_sample_accessions":' || sra_sample_accessions
   || ',"taxid":' || L.taxid || ',"unit_id":"' || unit_id || '"}}') AS fingerprint
   FROM L LEFT JOIN P ON L.taxid = P.taxid)"""
SQL_PRINTS = f"{SQL_CLEAN}, {_PRINTS}"


def fingerprints(t: Tables, catalog: Callable[[Tables], DataFrame] = clean_catalog) -> DataFrame:
    """Fingerprint of every BioSample unit of the clean catalog, or of another."""
    grouped = un.group_units(catalog(t), "BioSample", unique_runs=True)
    pins = t.nation.filter("n_nationkey % 5 = 0").select(
        F.col("n_nationkey").cast("bigint").alias("taxid"),
        F.concat(F.lit("GCF_"), F.col("n_nationkey")).alias("accession"),
    )
    return un.unit_fingerprints(
        grouped.table,
        un.accession_sets(grouped.members),
        group_by="biosample",
        processor_identity="demo:v1",
        fastq_identity=F.lit("archive"),
        pins=pins,
    )


@query("unit_fingerprints", f"WITH {SQL_APART}, {_PRINTS} SELECT unit_id, taxid, genome_pin, fingerprint FROM FP")
def unit_fingerprints(t: Tables) -> DataFrame:
    """Identity of the work of every unit."""
    return fingerprints(t, whole_catalog).select("unit_id", "taxid", "genome_pin", "fingerprint")


@query(
    "execution_digest",
    f"""WITH {SQL_APART}, {_PRINTS} SELECT sha256(string_agg(fingerprint, chr(10) ORDER BY unit_id)) AS digest,
    CAST(count(*) AS BIGINT) AS n FROM FP""",
)
def execution_digest(t: Tables) -> DataFrame:
    """Digest over all fingerprints in unit order."""
    return items_digest(fingerprints(t, whole_catalog).select("unit_id", "fingerprint"), ["unit_id"])


@query(
    "first_order_per_customer",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def first_order_per_customer(t: Tables) -> DataFrame:
    """Keep-first per key."""
    orders = with_order(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_orderkey")
    return keep_first(orders, ["o_custkey"]).drop(ORD)
