"""Queries that write text made from the test tables and scan it with the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.catalog import RunCatalog
from ..operators.reads import valid_read_sets
from ..session import shared_folder
from ..sources import archive_xml as ax
from ..sources.bundles import collections_from_document
from ..sources.fasta import chromosome_sizes, fasta_violations
from ..sources.files import read_manifests
from ..sources.tables import read_runinfo
from ..streaming.metadata_loads import MetadataLoad
from .registry import Tables, query


def _path(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _written(t: Tables, name: str, text: DataFrame) -> str:
    """Write the rows of a text column and return the folder."""
    path = _path(t, name)
    text.write.text(path)
    return path


def _say(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(
    "scanned_catalog",
    """SELECT 'R' || o_orderkey AS "Run", CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS VARCHAR) AS "TaxID",
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority || ', "' || o_orderstatus || '"' END AS "Platform",
    CAST(o_orderkey % 1000 AS DOUBLE) / 4 AS "size_MB", CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "ReleaseDate",
    'bigint,double,date' AS kinds FROM orders""",
)
def scanned_catalog(t: Tables) -> DataFrame:
    """A run table from CSV files: null markers, quotes, inferred types."""
    key = F.col("o_orderkey")
    rows = t.orders.select(
        _say("R", key).alias("Run"),
        F.when(key % 9 == 0, "NA").otherwise(F.col("o_custkey").cast("string")).alias("TaxID"),
        F.when(F.col("o_orderstatus") == "F", "null").otherwise(_say(F.col("o_orderpriority"), ', "', F.col("o_orderstatus"), '"')).alias("Platform"),
        ((key % 1000) / 4).alias("size_MB"),
        F.col("o_orderdate").cast("date").alias("ReleaseDate"),
    )
    path = _path(t, "catalog")
    rows.write.option("header", True).option("escape", '"').csv(path)
    catalog = RunCatalog.from_csv(t.spark, path)
    kinds = dict(catalog.frame.dtypes)
    found = ",".join(kinds[c] for c in ("TaxID", "size_MB", "ReleaseDate"))
    text = [F.col(c).cast("string").alias(c) for c in ("TaxID", "ReleaseDate")]
    return catalog.frame.select("Run", *text, "Platform", "size_MB", F.lit(found).alias("kinds"))


@query(
    "scanned_runinfo",
    """SELECT 'R' || l_orderkey || '.' || l_linenumber AS "Run", 'X' || l_orderkey AS "Experiment",
    'S' || l_suppkey AS "SRA Sample", 'P' || l_partkey AS "SRA Study" FROM lineitem WHERE l_linenumber <> 3""",
)
def scanned_runinfo(t: Tables) -> DataFrame:
    """Run-info pages with aliased columns; rows without a run are left."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = t.lineitem.select(
        F.when(line == 3, "").otherwise(_say("R", order, ".", line)).alias("Run"),
        _say("X", order).alias("Experiment"),
        _say("S", F.col("l_suppkey")).alias("Sample"),
        _say("P", F.col("l_partkey")).alias("SRAStudy"),
    )
    path = _path(t, "runinfo")
    rows.write.option("header", True).csv(path)
    return read_runinfo(t.spark, path).select("Run", "Experiment", "SRA Sample", "SRA Study")


def package_text(t: Tables) -> DataFrame:
    """An experiment package per order."""
    key = F.col("o_orderkey")
    return t.orders.select(
        _say(
            '<EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX', key, '"><TITLE>', F.col("o_orderpriority"), " &amp; ", F.col("o_orderstatus"),
            " &lt;", F.col("o_orderstatus"), '&gt; in &lt;b or <b>c</b>&#62;d</TITLE><STUDY_REF accession="SRP', F.col("o_custkey"), '"/><DESIGN><DESIGN_DESCRIPTION>of <i>order</i> ', key,
            "</DESIGN_DESCRIPTION><LIBRARY_DESCRIPTOR><LIBRARY_LAYOUT><SINGLE note='a&lt;", key % 7,
            ' &#51;00\' /></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN></EXPERIMENT><SAMPLE accession="SRS', F.col("o_custkey"),
            '"><IDENTIFIERS><EXTERNAL_ID namespace="BioSample">SAMN', F.col("o_custkey"), '</EXTERNAL_ID></IDENTIFIERS></SAMPLE><RUN_SET runs="1"><RUN accession="SRR',
            key, '" total_spots="', key * 3, '"/></RUN_SET></EXPERIMENT_PACKAGE>',
        ).alias("value")
    )


@query(
    "scanned_experiments",
    """SELECT 'SRX' || o_orderkey AS accession, o_orderpriority || ' & ' || o_orderstatus || ' <' || o_orderstatus || '> in <b or c>d' AS title, 'SRP' || o_custkey AS study_accession,
    'of order ' || o_orderkey AS description, 'SINGLE' AS layout, 'a<' || (o_orderkey % 7) || ' 300' AS note FROM orders""",
)
def scanned_experiments(t: Tables) -> DataFrame:
    """Experiments of package XML: entities, escaped and real tags in texts, attributes in single quotes."""
    bundle = ax.read_packages(t.spark, _written(t, "packages", package_text(t)))
    library = F.col("library")
    return bundle.experiments.select(
        "accession", "title", "study_accession", F.col("design_description").alias("description"), library["layout"].alias("layout"), library["layout_properties"]["note"].alias("note")
    )


@query("scanned_runs", "SELECT 'SRR' || o_orderkey AS accession, CAST(o_orderkey * 3 AS BIGINT) AS spots FROM orders")
def scanned_runs(t: Tables) -> DataFrame:
    """Runs of package XML."""
    return ax.read_packages(t.spark, _written(t, "packages", package_text(t))).runs.select("accession", "spots")


@query("cut_packages", "SELECT CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderkey % 11 = 0")
def cut_packages(t: Tables) -> DataFrame:
    """Records that a cut file leaves without an end tag are violations."""
    whole = F.length("value")
    number = F.regexp_extract("value", r"SRX(\d+)", 1).cast("bigint")
    cut = package_text(t).select(F.when(number % 11 == 0, F.substring("value", F.lit(1), whole - 40)).otherwise(F.col("value")).alias("value"))
    records = ax.parse_records(ax.read_records(t.spark, _written(t, "cut", cut), "EXPERIMENT_PACKAGE"), ax.PACKAGE_COLUMNS)
    return ax.malformed_records(records, "read_packages").agg(F.count(F.lit(1)).alias("n"))


def biosample_text(t: Tables) -> DataFrame:
    """A BioSample record per customer, half of them with two values of one attribute."""
    key = F.col("c_custkey")
    second = F.when(key % 2 == 0, _say('<Attribute attribute_name="Segment" harmonized_name="segment">again ', key, "</Attribute>")).otherwise("")
    return t.customer.select(
        _say(
            '<BioSample accession="SAMN', key, '" id="', key, '"><Ids><Id db="SRA">SRS', key, '</Id></Ids><Description><Title>', F.col("c_name"),
            ' &lt;i&gt;&#x21;</Title></Description><Attributes><Attribute attribute_name="segment">', F.col("c_mktsegment"), "</Attribute>", second, "</Attributes></BioSample>",
        ).alias("value")
    )


@query(
    "scanned_biosamples",
    """SELECT 'SAMN' || c_custkey AS accession, 'SRS' || c_custkey AS sra_sample, c_name || ' <i>!' AS title,
    c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN '|again ' || c_custkey ELSE '' END AS segment FROM customer""",
)
def scanned_biosamples(t: Tables) -> DataFrame:
    """BioSample XML with repeated attributes."""
    rows = ax.read_biosamples(t.spark, _written(t, "biosamples", biosample_text(t)))
    return rows.select("accession", "sra_sample", "title", F.array_join(F.col("attributes")["segment"], "|").alias("segment"))


@query(
    "scanned_supplementary",
    """SELECT url, 'GSM' || max(doc_id) AS geo_accession, regexp_extract(url, '[^/]+$') AS filename FROM (
    SELECT doc_id, 'ftp://h/' || lang || '/f' || (doc_id % 50) || '.txt' AS url FROM documents) GROUP BY url""",
)
def scanned_supplementary(t: Tables) -> DataFrame:
    """Supplementary files of family XML: distinct by URL, the last owner stays."""
    key = F.col("doc_id")
    text = t.documents.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").select(
        _say('<Sample iid="GSM', key, '"><Supplementary-Data>ftp://h/', F.col("lang"), "/f", key % 50, ".txt</Supplementary-Data></Sample>").alias("value")
    )
    return ax.read_supplementary(t.spark, _written(t, "family", text)).select("url", "geo_accession", "filename")


@query("scanned_links", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem WHERE l_linenumber <> 2")
def scanned_links(t: Tables) -> DataFrame:
    """Distinct linked ids of one target in link XML."""
    target = F.when(F.col("l_linenumber") == 2, "gds").otherwise("sra")
    text = t.lineitem.select(_say("<LinkSetDb><DbTo>", target, "</DbTo><Link><Id>", F.col("l_partkey"), "</Id></Link></LinkSetDb>").alias("value"))
    return ax.read_archive_links(t.spark, _written(t, "links", text)).select("id")


def fasta_text(t: Tables) -> DataFrame:
    """A sequence of several lines per part."""
    key = F.col("p_partkey")
    return t.part.select(
        _say(">p", key, " ", F.col("p_brand"), "\n", F.repeat(F.lit("ACGT"), F.col("p_size")), "\n\n", F.repeat(F.lit("N"), (key % 7).cast("int"))).alias("value")
    )


@query("scanned_sizes", "SELECT 'p' || p_partkey AS name, CAST(4 * p_size + p_partkey % 7 AS BIGINT) AS size FROM part")
def scanned_sizes(t: Tables) -> DataFrame:
    """Sequence sizes of FASTA files."""
    return chromosome_sizes(t.spark, _written(t, "fasta", fasta_text(t))).select("name", "size")


@query("fasta_problems", "SELECT 'sequence before header' AS detail, CAST(4 AS BIGINT) AS n WHERE (SELECT count(*) FROM part) >= 4")
def fasta_problems(t: Tables) -> DataFrame:
    """Files with sequence before their first header: each of the four that hold the table."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    headless = F.regexp_replace("value", r"^>[^\n]*\n", "")
    late = fasta_text(t).repartition(4).select(F.when(place == 0, headless).otherwise(F.col("value")).alias("value"))
    return fasta_violations(t.spark, _written(t, "fasta", late)).groupBy("detail").agg(F.count(F.lit(1)).alias("n"))


# Customers of successive keys whose samples share a document, one of each nation.
DOCUMENT_SAMPLES = 10_000


@query(
    "document_samples",
    """SELECT 'S' || c_custkey AS accession, c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '|' || c_name ELSE '' END AS segment FROM customer""",
)
def document_samples(t: Tables) -> DataFrame:
    """Samples of JSON documents whose attribute values are one text or a list."""
    many = F.to_json(F.array("c_mktsegment", "c_name"))
    value = F.when(F.col("c_custkey") % 3 == 0, many).otherwise(_say('"', F.col("c_mktsegment"), '"'))
    sample = _say('{"accession": "S', F.col("c_custkey"), '", "attributes": {"segment": ', value, "}}")
    part = (F.col("c_custkey") / DOCUMENT_SAMPLES).cast("bigint")
    listed = t.customer.groupBy("c_nationkey", part.alias("part")).agg(F.concat_ws(",", F.collect_list(sample)).alias("samples"))
    path = _written(t, "documents", listed.select(_say('{"sra_samples": [', F.col("samples"), "]}").alias("value")))
    bundle = collections_from_document(t.spark, path, lines=True)
    return bundle.sra_samples.select("accession", F.array_join(F.col("attributes")["segment"], "|").alias("segment"))


@query(
    "loaded_metadata",
    """SELECT 'experiment' AS kind, 'SRX' || o_orderkey AS accession FROM orders UNION ALL
    SELECT 'biosample', 'SAMN' || c_custkey FROM customer""",
)
def loaded_metadata(t: Tables) -> DataFrame:
    """Both kinds of metadata, loaded by two streams into one cumulative store."""
    load = MetadataLoad(t.spark, _path(t, "store"))
    packages, samples = _written(t, "packages", package_text(t)), _written(t, "biosamples", biosample_text(t))
    for _ in range(2):  # the second time nothing is new
        load.load_packages(packages, f"{load.directory}-packages").awaitTermination()
        load.load_biosamples(samples, f"{load.directory}-biosamples").awaitTermination()
    bundle = load.current()
    kinds = [bundle.experiments.select(F.lit("experiment").alias("kind"), "accession"), bundle.biosamples.select(F.lit("biosample").alias("kind"), "accession")]
    return kinds[0].unionByName(kinds[1])


@query(
    "read_set_validity",
    """SELECT 'U' || o_orderkey AS unit_id, o_custkey % 4 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 1 AND o_orderkey % 17 <> 3 AS valid FROM orders""",
)
def read_set_validity(t: Tables) -> DataFrame:
    """Whether cached read sets are intact, from manifests that are written and scanned."""
    files = t.customer.select(
        _say("/c/", F.col("c_custkey"), ".fq").alias("path"), F.when(F.col("c_custkey") % 4 == 0, 0).otherwise(9).alias("size"), F.sha2("c_name", 256).alias("sha256")
    )
    own, key = _say("/c/", F.col("o_custkey"), ".fq"), F.col("o_orderkey")
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    manifest = F.struct(
        _say("U", key).alias("unit_id"),
        F.when(key % 6 == 1, F.lit("paired")).otherwise(F.lit("single")).alias("layout"),
        F.array(own).alias("single"),
        F.create_map(F.when(key % 17 == 3, _say(own, ".other")).otherwise(own), F.when(key % 5 == 0, F.lit("x")).otherwise(F.sha2("c_name", 256))).alias("checksums"),
    )
    path = _written(t, "manifests", named.select(F.to_json(manifest).alias("value")))
    return valid_read_sets(read_manifests(t.spark, path, documents=False), files)
