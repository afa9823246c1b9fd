"""Archive XML as tables, parsed by Spark's own XML reader with explicit types.

Files are split at the end tag of a record, so one record is one row and a landing
folder of any size is read in parallel; ``from_xml`` then gives a typed struct and the
collections are plain projections of it. Nothing is parsed in Python except the
optional lossless tree.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.names import last_component
from ..functions.text import squeeze
from ..functions.values import blank_to_null, bytes_to_gb, fold_attributes, identifier_in, lenient_int, pubmed_ids
from ..operators.bundle import Bundle, accession_unique
from ..ordering import ORD, distinct_in_order, keep_first
from ..violations import require_none, violation_rows
from .tables import read_position

_PAIR = "STRUCT<_VALUE: STRING, _namespace: STRING, _db: STRING, _db_label: STRING, _label: STRING, _is_primary: STRING>"
_IDS = (
    f"STRUCT<PRIMARY_ID: ARRAY<{_PAIR}>, SECONDARY_ID: ARRAY<{_PAIR}>, EXTERNAL_ID: ARRAY<{_PAIR}>,"
    f" SUBMITTER_ID: ARRAY<{_PAIR}>, UUID: ARRAY<{_PAIR}>>"
)
_TAGGED = "STRUCT<TAG: STRING, VALUE: STRING, UNITS: STRING, _unit: STRING, _units: STRING>"
_XREF = "STRUCT<DB: STRING, ID: STRING, LABEL: STRING>"
_URL = "STRUCT<LABEL: STRING, URL: STRING>"
_LINKS = f"ARRAY<STRUCT<XREF_LINK: {_XREF}, URL_LINK: {_URL}, ENTREZ_LINK: {_XREF}>>"
_POOL = (
    "STRUCT<Member: ARRAY<STRUCT<_accession: STRING, _member_name: STRING, _sample_name: STRING,"
    f" _sample_title: STRING, _spots: STRING, _bases: STRING, _tax_id: STRING, _organism: STRING, IDENTIFIERS: {_IDS}>>>"
)
_CONTACT = "STRUCT<_email: STRING, Name: STRUCT<First: STRING, Last: STRING>>"
_FILE_ATTRIBUTES = ("cluster", "filename", "url", "size", "date", "md5", "version", "semantic_name", "supertype", "sratoolkit")
_ALT_ATTRIBUTES = ("url", "free_egress", "access_type", "org")
_FILES = (
    "STRUCT<SRAFile: ARRAY<STRUCT<"
    + ", ".join(f"_{a}: STRING" for a in _FILE_ATTRIBUTES)
    + ", Alternatives: ARRAY<STRUCT<"
    + ", ".join(f"_{a}: STRING" for a in _ALT_ATTRIBUTES)
    + ">>>>>"
)
_RUN = (
    "STRUCT<_accession: STRING, _alias: STRING, _total_spots: STRING, _total_bases: STRING, _size: STRING,"
    " _published: STRING, _load_done: STRING, _is_public: STRING, _cluster_name: STRING,"
    f" IDENTIFIERS: {_IDS}, TITLE: STRING, EXPERIMENT_REF: STRUCT<_accession: STRING, _refname: STRING>,"
    f" Pool: {_POOL}, SRAFiles: {_FILES}, Statistics: STRUCT<_nreads: STRING, _nspots: STRING>,"
    f" RUN_ATTRIBUTES: STRUCT<RUN_ATTRIBUTE: ARRAY<{_TAGGED}>>>"
)
PACKAGE_COLUMNS = (
    "EXPERIMENT STRUCT<_accession: STRING, _alias: STRING,"
    f" IDENTIFIERS: {_IDS}, TITLE: STRING, STUDY_REF: STRUCT<_accession: STRING>,"
    " DESIGN: STRUCT<DESIGN_DESCRIPTION: STRING, SAMPLE_DESCRIPTOR: STRUCT<_accession: STRING>,"
    " LIBRARY_DESCRIPTOR: STRUCT<LIBRARY_NAME: STRING, LIBRARY_STRATEGY: STRING, LIBRARY_SOURCE: STRING,"
    " LIBRARY_SELECTION: STRING, LIBRARY_LAYOUT: MAP<STRING, STRING>,"
    " LIBRARY_CONSTRUCTION_PROTOCOL: STRING>>, PLATFORM: MAP<STRING, STRUCT<INSTRUMENT_MODEL: STRING>>,"
    f" EXPERIMENT_LINKS: STRUCT<EXPERIMENT_LINK: {_LINKS}>,"
    f" EXPERIMENT_ATTRIBUTES: STRUCT<EXPERIMENT_ATTRIBUTE: ARRAY<{_TAGGED}>>>,"
    " SUBMISSION STRUCT<_accession: STRING, _alias: STRING, _broker_name: STRING, _center_name: STRING,"
    f" _lab_name: STRING, _submission_comment: STRING, IDENTIFIERS: {_IDS}>,"
    " Organization STRUCT<_type: STRING, Name: STRUCT<_VALUE: STRING, _abbr: STRING>,"
    f" Contact: ARRAY<{_CONTACT}>>,"
    f" STUDY STRUCT<_accession: STRING, _alias: STRING, _center_name: STRING, IDENTIFIERS: {_IDS},"
    " DESCRIPTOR: STRUCT<STUDY_TITLE: STRING, STUDY_TYPE: STRUCT<_existing_study_type: STRING>,"
    f" STUDY_ABSTRACT: STRING, CENTER_PROJECT_NAME: STRING>, STUDY_LINKS: STRUCT<STUDY_LINK: {_LINKS}>,"
    f" STUDY_ATTRIBUTES: STRUCT<STUDY_ATTRIBUTE: ARRAY<{_TAGGED}>>>,"
    f" SAMPLE STRUCT<_accession: STRING, _alias: STRING, IDENTIFIERS: {_IDS}, TITLE: STRING,"
    " SAMPLE_NAME: STRUCT<TAXON_ID: STRING, SCIENTIFIC_NAME: STRING>,"
    f" SAMPLE_LINKS: STRUCT<SAMPLE_LINK: {_LINKS}>,"
    f" SAMPLE_ATTRIBUTES: STRUCT<SAMPLE_ATTRIBUTE: ARRAY<{_TAGGED}>>>,"
    f" Pool {_POOL},"
    f" RUN_SET STRUCT<_runs: STRING, _spots: STRING, _bases: STRING, _bytes: STRING, RUN: ARRAY<{_RUN}>>,"
    " _corrupt STRING"
)
_ATTRIBUTE_NAMES = ("attribute_name", "harmonized_name", "display_name", "unit", "units")
BIOSAMPLE_COLUMNS = (
    "_accession STRING, _id STRING, _access STRING, _publication_date STRING, _last_update STRING,"
    f" _submission_date STRING, Ids STRUCT<Id: ARRAY<{_PAIR}>>,"
    " Description STRUCT<Title: STRING, Organism: STRUCT<_taxonomy_id: STRING, _taxonomy_name: STRING>,"
    " Comment: STRUCT<_VALUE: STRING, Paragraph: ARRAY<STRING>>>,"
    f" Owner STRUCT<Name: STRUCT<_VALUE: STRING>, Contacts: STRUCT<Contact: ARRAY<{_CONTACT}>>>,"
    " Models STRUCT<Model: ARRAY<STRING>>, Package STRUCT<_VALUE: STRING, _display_name: STRING>,"
    " Attributes STRUCT<Attribute: ARRAY<STRUCT<_VALUE: STRING, "
    + ", ".join(f"_{a}: STRING" for a in _ATTRIBUTE_NAMES)
    + ">>>, Links STRUCT<Link: ARRAY<STRUCT<_VALUE: STRING, _type: STRING, _target: STRING, _label: STRING>>>,"
    " Status STRUCT<_status: STRING, _when: STRING>, _corrupt STRING"
)
#: Tags of presentation inside a text; the archive's own elements have capitals. They are
#: taken out before parsing, where an escaped ``<`` is still told from a tag.
PRESENTATION = (
    r"</?(?:[a-z][a-z0-9]*|(?i:i|b|u|p|a|em|strong|su[bp]|br|hr|span|font|tt|small|big|div|[uod]l|li|h[1-6]))(?:\s[^<>]*)?/?>"
)
_XML_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt", "ignoreNamespace": "true", "mode": "PERMISSIVE"}
_ID_KINDS = {
    "PRIMARY_ID": "primary",
    "SECONDARY_ID": "secondary_id",
    "EXTERNAL_ID": "external",
    "SUBMITTER_ID": "submitter",
    "UUID": "uuid",
}
NO_IDENTIFIERS = "array<struct<kind:string,value:string,namespace:string,label:string,is_primary:string>>"


def _tree(element: ET.Element) -> dict:
    node: dict = {}
    if element.attrib:
        node["@attributes"] = dict(element.attrib)
    if element.text and element.text.strip():
        node["#text"] = element.text.strip()
    groups: dict[str, list] = {}
    for child in element:
        groups.setdefault(child.tag.rpartition("}")[2], []).append(_tree(child))
    return node | {tag: nodes if len(nodes) > 1 else nodes[0] for tag, nodes in groups.items()}


@F.pandas_udf(StringType())
def _tree_json(documents: pd.Series) -> pd.Series:
    def convert(text: str) -> str | None:
        try:
            return json.dumps(_tree(ET.fromstring(text)), sort_keys=True, ensure_ascii=False)
        except ET.ParseError:
            return None

    return documents.map(convert, na_action="ignore")


def lossless_tree(xml: Column) -> Column:
    """XML record as canonical JSON with attributes, text and repeated children."""
    return _tree_json(xml)


def record_text(chunk: Column, tag: str) -> Column:
    """Text of the ``tag`` record in a chunk that begins after ``<tag``, or null.

    A record ends at its end tag. Where a cut file lacks it, the text stays without one, so
    the parser finds it malformed instead of taking half a record for a whole one.
    """
    end = f"</{tag}>"
    begins = chunk.rlike(r"^(?:\s*/?>|\s+[^\s<])")
    alone = F.regexp_extract(chunk, r"^[^<>]*/>", 0)
    whole = F.concat(F.substring_index(chunk, end, 1), F.lit(end))
    body = F.when(alone != "", alone).when(F.contains(chunk, F.lit(end)), whole).otherwise(chunk)
    return F.when(begins, F.concat(F.lit(f"<{tag}"), body))


def read_records(spark: SparkSession, path, tag: str) -> DataFrame:
    """One row per ``tag`` record with its text and position."""
    chunks = spark.read.text(path, lineSep=f"<{tag}")
    return chunks.select(record_text(F.col("value"), tag).alias("xml"), read_position().alias(ORD)).filter(
        F.col("xml").isNotNull()
    )


def parse_records(records: DataFrame, columns: str | StructType) -> DataFrame:
    """Typed struct ``r`` of each record; text that is not well formed sets ``_corrupt``.

    The struct is exploded from an array of one, which the optimizer does not see through:
    otherwise every filter on a field is pushed below and parses the text once more.
    """
    r = F.from_xml(_without_presentation(F.col("xml")), columns, _XML_OPTIONS)
    return records.select("*", F.explode(F.array(r)).alias("r"))


def _without_presentation(xml: Column) -> Column:
    return F.regexp_replace(xml, PRESENTATION, "")


def suspect_records(records: DataFrame) -> DataFrame:
    """Records that may be malformed, told without building their structs.

    Taking whole tags of presentation out of a well-formed text leaves it well formed, save
    where that joins a ``]]>``; so only texts that are not well formed as they stand, or
    have ``]]``, need the full parse for a verdict.
    """
    broken = F.from_xml("xml", "_corrupt STRING", _XML_OPTIONS)["_corrupt"].isNotNull()
    return records.filter(broken | F.contains("xml", F.lit("]]")))


def well_formed(parsed: DataFrame, *, strict: bool) -> DataFrame:
    """Parsed records that are well formed; when strict, any other one is an error in its task."""
    fine = F.col("r._corrupt").isNull()
    return parsed.filter(F.when(fine, True).otherwise(F.raise_error(F.lit("malformed XML")).cast("boolean")) if strict else fine)


def malformed_records(parsed: DataFrame, operator: str) -> DataFrame:
    """Records that are not well formed, as violation rows."""
    return violation_rows(
        parsed.filter(F.col("r._corrupt").isNotNull()), operator, F.col(f"{ORD}.file"), F.lit("malformed XML")
    )


def _clean(value: Column) -> Column:
    """Squeezed text, or null for none."""
    return blank_to_null(squeeze(value))


def _id_record(kind: Column, e: Column) -> Column:
    return F.struct(
        kind.alias("kind"),
        _clean(e["_VALUE"]).alias("value"),
        F.coalesce(blank_to_null(e["_namespace"]), blank_to_null(e["_db"]), blank_to_null(e["_db_label"])).alias("namespace"),
        e["_label"].alias("label"),
        e["_is_primary"].alias("is_primary"),
    )


def _identifiers(container: Column) -> Column:
    def group(tag: str, kind: str) -> Column:
        # A lambda with a second parameter would get the position of the element in it.
        return F.coalesce(F.transform(container[tag], lambda e: _id_record(F.lit(kind), e)), F.array().cast(NO_IDENTIFIERS))

    groups = [group(tag, kind) for tag, kind in _ID_KINDS.items()]
    return F.filter(F.concat(*groups), lambda i: i["value"].isNotNull())


def _tagged(elements: Column) -> Column:
    records = F.transform(
        elements,
        lambda e: F.struct(
            _clean(e["TAG"]).alias("name"),
            _clean(e["VALUE"]).alias("value"),
            F.coalesce(_clean(e["UNITS"]), blank_to_null(e["_unit"]), blank_to_null(e["_units"])).alias("units"),
            F.lit(None).cast("map<string,string>").alias("properties"),
        ),
    )
    return F.coalesce(
        F.filter(records, lambda r: r["name"].isNotNull() & r["value"].isNotNull()),
        F.array().cast("array<struct<name:string,value:string,units:string,properties:map<string,string>>>"),
    )


def _link(kind: str, database=None, identifier=None, label=None, url=None, value=None, attrs=None) -> Column:
    def text(column):
        return F.lit(None).cast("string") if column is None else column

    return F.struct(
        F.lit(kind).alias("type") if isinstance(kind, str) else kind.alias("type"),
        text(database).alias("database"),
        text(identifier).alias("id"),
        text(label).alias("label"),
        text(url).alias("url"),
        text(value).alias("value"),
        (F.lit(None).cast("map<string,string>") if attrs is None else attrs).alias("attrs"),
    )


def _links(elements: Column) -> Column:
    def one(e: Column) -> Column:
        x, u, n = e["XREF_LINK"], e["URL_LINK"], e["ENTREZ_LINK"]
        return (
            F.when(x.isNotNull(), _link("xref", _clean(x["DB"]), _clean(x["ID"]), _clean(x["LABEL"])))
            .when(u.isNotNull(), _link("url", label=_clean(u["LABEL"]), url=_clean(u["URL"])))
            .when(n.isNotNull(), _link("entrez", _clean(n["DB"]), _clean(n["ID"])))
        )

    listed = F.array_compact(F.transform(elements, one))
    empty = "array<struct<type:string,database:string,id:string,label:string,url:string,value:string,attrs:map<string,string>>>"
    return F.coalesce(listed, F.array().cast(empty))


def _non_null_map(names, node: Column) -> Column:
    entries = [F.struct(F.lit(n).alias("key"), node[f"_{n}"].alias("value")) for n in names]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def _members(pool: Column) -> Column:
    fields = ("accession", "member_name", "sample_name", "sample_title", "spots", "bases", "tax_id", "organism")

    def one(m: Column) -> Column:
        ids = _identifiers(m["IDENTIFIERS"])
        return F.struct(
            *[m[f"_{f}"].alias(f) for f in fields],
            ids.alias("identifiers"),
            identifier_in(ids, "biosample").alias("biosample"),
            identifier_in(ids, "geo").alias("geo"),
        )

    return F.transform(pool["Member"], one)


def _accession(node: Column) -> Column:
    return F.coalesce(blank_to_null(node["_accession"]), blank_to_null(node["_alias"]))


def _contacts(contacts: Column) -> Column:
    return F.transform(
        contacts,
        lambda c: F.struct(
            _clean(c["Name"]["First"]).alias("first_name"),
            _clean(c["Name"]["Last"]).alias("last_name"),
            c["_email"].alias("email"),
        ),
    )


def _with_attributes(df: DataFrame) -> DataFrame:
    return df.withColumn("attributes", fold_attributes(F.col("attribute_records")))


def layout_properties(xml: Column) -> Column:
    """Attributes of the layout element; the XML reader drops those of empty map values.

    Each attribute becomes an element of its own, so the reader decodes its references.
    """
    text = F.regexp_extract(xml, r"""(?s)<LIBRARY_LAYOUT>\s*<\w+\s((?:[^<>"']++|"[^"]*"|'[^']*')*+)>""", 1)
    pairs = F.regexp_extract_all(text, F.lit(r"""([\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))"""), F.lit(1))
    elements = F.transform(pairs, lambda p: F.regexp_replace(p, r"""(?s)^([\w:.-]+)\s*=\s*["'](.*)["']$""", "<e><k>$1</k><v>$2</v></e>"))
    read = F.from_xml(F.concat(F.lit("<r>"), F.array_join(elements, ""), F.lit("</r>")), "e ARRAY<STRUCT<k: STRING, v: STRING>>")["e"]
    entries = F.transform(F.coalesce(read, F.array().cast("array<struct<k:string,v:string>>")), lambda e: F.struct(e["k"], F.coalesce(e["v"], F.lit(""))))
    return F.map_from_entries(entries)


def package_parser(records: DataFrame) -> Callable[..., DataFrame]:
    """Parses the named parts of package records and leaves the others out."""
    fields = StructType.fromDDL(PACKAGE_COLUMNS)

    def parse(*parts: str) -> DataFrame:
        return parse_records(records, StructType([f for f in fields if f.name in (*parts, "_corrupt")]))

    return parse


def packages_bundle(parsed: DataFrame | Callable[..., DataFrame], *, include_raw: bool = False, strict: bool = False) -> Bundle:
    """The collections of parsed package records; the first record per accession wins.

    ``parsed`` is a table of parsed records or a ``package_parser``, by which each collection
    parses the parts that it is made of.
    """
    raw = lossless_tree(F.col("xml")) if include_raw else F.lit(None).cast("string")

    def trees(*parts: str) -> DataFrame:
        table = parsed if isinstance(parsed, DataFrame) else parsed(*parts)
        return well_formed(table, strict=strict).select("r.*", "xml", ORD, raw.alias("_raw"))

    def part(name: str) -> Column:
        path = {"experiments": "EXPERIMENT", "studies": "STUDY", "sra_samples": "SAMPLE", "submissions": "SUBMISSION"}[name]
        return F.get_json_object("_raw", f"$.{path}").alias("raw")

    e, s, m, b, o = (F.col(c) for c in ("EXPERIMENT", "STUDY", "SAMPLE", "SUBMISSION", "Organization"))
    library, layout = e["DESIGN"]["LIBRARY_DESCRIPTOR"], e["DESIGN"]["LIBRARY_DESCRIPTOR"]["LIBRARY_LAYOUT"]
    layout_name = F.try_element_at(F.map_keys(layout), F.lit(1))
    platform = e["PLATFORM"]
    experiments = trees("EXPERIMENT").filter(e.isNotNull()).select(
        _accession(e).alias("accession"),
        e["_alias"].alias("alias"),
        _identifiers(e["IDENTIFIERS"]).alias("identifiers"),
        _clean(e["TITLE"]).alias("title"),
        e["STUDY_REF"]["_accession"].alias("study_accession"),
        e["DESIGN"]["SAMPLE_DESCRIPTOR"]["_accession"].alias("sample_accession"),
        _clean(e["DESIGN"]["DESIGN_DESCRIPTION"]).alias("design_description"),
        F.struct(
            _clean(library["LIBRARY_NAME"]).alias("name"),
            _clean(library["LIBRARY_STRATEGY"]).alias("strategy"),
            _clean(library["LIBRARY_SOURCE"]).alias("source"),
            _clean(library["LIBRARY_SELECTION"]).alias("selection"),
            layout_name.alias("layout"),
            layout_properties(F.col("xml")).alias("layout_properties"),
            _clean(library["LIBRARY_CONSTRUCTION_PROTOCOL"]).alias("construction_protocol"),
        ).alias("library"),
        F.struct(
            F.try_element_at(F.map_keys(platform), F.lit(1)).alias("name"),
            _clean(F.try_element_at(F.map_values(platform), F.lit(1))["INSTRUMENT_MODEL"]).alias("instrument_model"),
        ).alias("platform"),
        _links(e["EXPERIMENT_LINKS"]["EXPERIMENT_LINK"]).alias("links"),
        _tagged(e["EXPERIMENT_ATTRIBUTES"]["EXPERIMENT_ATTRIBUTE"]).alias("attribute_records"),
        part("experiments"),
        ORD,
    )
    studies = trees("STUDY").filter(s.isNotNull()).select(
        _accession(s).alias("accession"),
        s["_alias"].alias("alias"),
        s["_center_name"].alias("center_name"),
        _identifiers(s["IDENTIFIERS"]).alias("identifiers"),
        identifier_in(_identifiers(s["IDENTIFIERS"]), "bioproject").alias("bioproject"),
        identifier_in(_identifiers(s["IDENTIFIERS"]), "geo").alias("geo"),
        _clean(s["DESCRIPTOR"]["STUDY_TITLE"]).alias("title"),
        s["DESCRIPTOR"]["STUDY_TYPE"]["_existing_study_type"].alias("type"),
        _clean(s["DESCRIPTOR"]["STUDY_ABSTRACT"]).alias("abstract"),
        _clean(s["DESCRIPTOR"]["CENTER_PROJECT_NAME"]).alias("center_project_name"),
        _links(s["STUDY_LINKS"]["STUDY_LINK"]).alias("links"),
        pubmed_ids(_links(s["STUDY_LINKS"]["STUDY_LINK"])).alias("pubmed_ids"),
        _tagged(s["STUDY_ATTRIBUTES"]["STUDY_ATTRIBUTE"]).alias("attribute_records"),
        part("studies"),
        ORD,
    )
    samples = trees("SAMPLE").filter(m.isNotNull()).select(
        _accession(m).alias("accession"),
        m["_alias"].alias("alias"),
        _identifiers(m["IDENTIFIERS"]).alias("identifiers"),
        identifier_in(_identifiers(m["IDENTIFIERS"]), "biosample").alias("biosample"),
        identifier_in(_identifiers(m["IDENTIFIERS"]), "geo").alias("geo"),
        _clean(m["TITLE"]).alias("title"),
        _clean(m["SAMPLE_NAME"]["SCIENTIFIC_NAME"]).alias("organism"),
        _clean(m["SAMPLE_NAME"]["TAXON_ID"]).alias("taxid"),
        _links(m["SAMPLE_LINKS"]["SAMPLE_LINK"]).alias("links"),
        _tagged(m["SAMPLE_ATTRIBUTES"]["SAMPLE_ATTRIBUTE"]).alias("attribute_records"),
        part("sra_samples"),
        ORD,
    )
    submissions = trees("SUBMISSION", "Organization").filter(b.isNotNull()).select(
        _accession(b).alias("accession"),
        b["_alias"].alias("alias"),
        b["_broker_name"].alias("broker_name"),
        b["_center_name"].alias("center_name"),
        b["_lab_name"].alias("lab_name"),
        b["_submission_comment"].alias("comment"),
        _identifiers(b["IDENTIFIERS"]).alias("identifiers"),
        F.when(
            o.isNotNull(),
            F.struct(
                o["_type"].alias("type"),
                _clean(o["Name"]["_VALUE"]).alias("name"),
                o["Name"]["_abbr"].alias("abbreviation"),
                _contacts(o["Contact"]).alias("contacts"),
            ),
        ).alias("organization"),
        part("submissions"),
        ORD,
    )
    run = F.col("_run")
    runs = (
        trees("RUN_SET").select("_raw", ORD, F.posexplode("RUN_SET.RUN").alias("_pos", "_run"))
        .select(
            _accession(run).alias("accession"),
            run["_alias"].alias("alias"),
            _identifiers(run["IDENTIFIERS"]).alias("identifiers"),
            _clean(run["TITLE"]).alias("title"),
            run["EXPERIMENT_REF"]["_accession"].alias("experiment_accession"),
            run["EXPERIMENT_REF"]["_refname"].alias("experiment_refname"),
            lenient_int(run["_total_spots"]).alias("spots"),
            lenient_int(run["_total_bases"]).alias("bases"),
            bytes_to_gb(run["_size"]).alias("size_gb"),
            run["_published"].alias("published_at"),
            run["_load_done"].alias("loaded"),
            run["_is_public"].alias("is_public"),
            run["_cluster_name"].alias("cluster_name"),
            _members(run["Pool"]).alias("members"),
            F.transform(
                run["SRAFiles"]["SRAFile"],
                lambda f: F.struct(
                    _non_null_map(_FILE_ATTRIBUTES, f).alias("attrs"),
                    F.transform(f["Alternatives"], lambda a: _non_null_map(_ALT_ATTRIBUTES, a)).alias("alternatives"),
                ),
            ).alias("files"),
            F.struct(
                lenient_int(run["Statistics"]["_nreads"]).alias("reads"),
                lenient_int(run["Statistics"]["_nspots"]).alias("spots"),
            ).alias("statistics"),
            _tagged(run["RUN_ATTRIBUTES"]["RUN_ATTRIBUTE"]).alias("attribute_records"),
            F.coalesce(
                F.get_json_object("_raw", "$.RUN_SET.RUN[0]"), F.get_json_object("_raw", "$.RUN_SET.RUN")
            ).alias("_first_raw"),
            F.from_json(F.get_json_object("_raw", "$.RUN_SET.RUN"), "array<string>").alias("_run_raws"),
            "_pos",
            F.struct(f"{ORD}.*", F.col("_pos").alias("item")).alias(ORD),
        )
        .withColumn("raw", F.coalesce(F.try_element_at("_run_raws", F.col("_pos") + 1), F.col("_first_raw")))
        .drop("_run_raws", "_first_raw", "_pos")
    )
    total = F.col("RUN_SET")
    key = F.coalesce(_accession(e), F.concat(F.lit("package-"), F.sha2(F.to_json(F.col(ORD)), 256)))
    packages = trees("EXPERIMENT", "STUDY", "SAMPLE", "SUBMISSION", "Pool", "RUN_SET").select(
        key.alias("accession"),
        _accession(e).alias("experiment_accession"),
        _accession(s).alias("study_accession"),
        _accession(m).alias("sra_sample_accession"),
        _accession(b).alias("submission_accession"),
        F.coalesce(
            F.array_compact(F.transform("RUN_SET.RUN", _accession)), F.array().cast("array<string>")
        ).alias("run_accessions"),
        _members(F.col("Pool")).alias("members"),
        F.struct(
            lenient_int(total["_runs"]).alias("runs"),
            lenient_int(total["_spots"]).alias("spots"),
            lenient_int(total["_bases"]).alias("bases"),
            bytes_to_gb(total["_bytes"]).alias("size_gb"),
        ).alias("totals"),
        ORD,
    )
    raw_packages = trees("EXPERIMENT").select(_accession(e).alias("experiment_accession"), F.col("_raw").alias("raw"), ORD)
    return Bundle(
        packages=keep_first(packages, ["accession"]),
        runs=accession_unique(_with_attributes(runs)),
        experiments=accession_unique(_with_attributes(experiments)),
        sra_samples=accession_unique(_with_attributes(samples)),
        studies=accession_unique(_with_attributes(studies)),
        submissions=accession_unique(submissions),
        raw_sra_packages=raw_packages.filter(F.col("raw").isNotNull()),
    )


def read_packages(spark: SparkSession, path, *, include_raw: bool = False, strict: bool = True) -> Bundle:
    """Experiment packages of a landing folder as a bundle without BioSamples."""
    records = read_records(spark, path, "EXPERIMENT_PACKAGE")
    if strict:
        require_none(malformed_records(parse_records(suspect_records(records), PACKAGE_COLUMNS), "read_packages"))
    return packages_bundle(package_parser(records), include_raw=include_raw, strict=strict)


def biosample_table(parsed: DataFrame, *, include_raw: bool = False, strict: bool = False) -> DataFrame:
    """BioSample records; the first per accession wins."""
    raw = lossless_tree(F.col("xml")) if include_raw else F.lit(None).cast("string")
    good = well_formed(parsed, strict=strict).select("r.*", ORD, raw.alias("raw"))
    ids = F.filter(
        F.coalesce(F.transform("Ids.Id", lambda e: _id_record(F.lit("id"), e)), F.array().cast(NO_IDENTIFIERS)),
        lambda i: i["value"].isNotNull(),
    )
    records = F.filter(
        F.transform(
            "Attributes.Attribute",
            lambda a: F.struct(
                F.coalesce(*[blank_to_null(a[f"_{n}"]) for n in ("harmonized_name", "attribute_name", "display_name")]).alias("name"),
                _clean(a["_VALUE"]).alias("value"),
                F.coalesce(blank_to_null(a["_unit"]), blank_to_null(a["_units"])).alias("units"),
                _non_null_map(_ATTRIBUTE_NAMES, a).alias("properties"),
            ),
        ),
        lambda r: r["name"].isNotNull() & r["value"].isNotNull(),
    )
    links = F.transform(
        "Links.Link",
        lambda l: _link(
            F.coalesce(l["_type"], F.lit("link")), label=l["_label"], value=_clean(l["_VALUE"]),
            attrs=_non_null_map(("type", "target", "label"), l),
        ),
    )
    comment = F.concat_ws(" ", F.col("Description.Comment._VALUE"), F.array_join("Description.Comment.Paragraph", " "))
    table = good.select(
        blank_to_null(F.col("_accession")).alias("accession"),
        *[F.col(f"_{n}").alias(n) for n in ("id", "access", "publication_date", "last_update", "submission_date")],
        ids.alias("identifiers"),
        identifier_in(ids, "sra").alias("sra_sample"),
        identifier_in(ids, "geo").alias("geo"),
        _clean(F.col("Description.Title")).alias("title"),
        _clean(comment).alias("comment"),
        F.col("Description.Organism._taxonomy_name").alias("organism"),
        F.col("Description.Organism._taxonomy_id").alias("taxid"),
        F.when(
            F.col("Owner").isNotNull(),
            F.struct(_clean(F.col("Owner.Name._VALUE")).alias("name"), _contacts(F.col("Owner.Contacts.Contact")).alias("contacts")),
        ).alias("owner"),
        F.array_compact(F.transform("Models.Model", _clean)).alias("models"),
        F.when(
            F.col("Package").isNotNull(),
            F.struct(_clean(F.col("Package._VALUE")).alias("name"), F.col("Package._display_name").alias("display_name")),
        ).alias("package"),
        F.coalesce(
            records, F.array().cast("array<struct<name:string,value:string,units:string,properties:map<string,string>>>")
        ).alias("attribute_records"),
        links.alias("links"),
        F.when(F.col("Status").isNotNull(), _non_null_map(("status", "when"), F.col("Status"))).alias("status"),
        "raw",
        ORD,
    )
    return accession_unique(_with_attributes(table))


def read_biosamples(spark: SparkSession, path, *, include_raw: bool = False, strict: bool = True) -> DataFrame:
    """BioSample records of a landing folder."""
    records = read_records(spark, path, "BioSample")
    if strict:
        require_none(malformed_records(parse_records(suspect_records(records), BIOSAMPLE_COLUMNS), "read_biosamples"))
    return biosample_table(parse_records(records, BIOSAMPLE_COLUMNS), include_raw=include_raw, strict=strict)


def family_records(spark: SparkSession, path) -> DataFrame:
    """Sample (rank 0) and series (rank 1) records of family files, in one reading.

    Files are cut where a sample begins; a series stands before the first sample or after
    the end of another, in the same piece. So no piece is larger than a sample and the
    series beside it, whichever comes first in the file.
    """
    pieces = spark.read.text(path, lineSep="<Sample").select("value", read_position().alias("_at"))
    series = F.regexp_extract_all("value", F.lit(r"(?s)(<Series(?:\s[^<>]*)?>.*?</Series>)"), F.lit(1))
    sample = F.array_compact(F.array(record_text(F.col("value"), "Sample")))
    both = F.concat(
        F.transform(sample, lambda xml: F.struct(F.lit(0).alias("rank"), xml.alias("xml"))),
        F.transform(series, lambda xml: F.struct(F.lit(1).alias("rank"), xml.alias("xml"))),
    )
    rows = pieces.select("_at", F.posexplode(both).alias("nth", "record"))
    order = F.struct("_at.file", F.col("record.rank").alias("kind"), "_at.split", "_at.row", "nth")
    return rows.select(F.col("record.xml").alias("xml"), order.alias(ORD))


def read_supplementary(spark: SparkSession, path, *, series: str | None = None) -> DataFrame:
    """Supplementary files declared by the samples and series of family files.

    A URL keeps its first position and the owner that declared it last.
    """
    columns = "_iid STRING, `Supplementary-Data` ARRAY<STRING>, _corrupt STRING"
    listed = parse_records(family_records(spark, path), columns).select(
        F.coalesce(blank_to_null(F.col("r._iid")), F.lit(series)).alias("geo_accession"),
        ORD,
        F.posexplode(F.col("r")["Supplementary-Data"]).alias("item", "url"),
    )
    named = listed.select("geo_accession", _clean(F.col("url")).alias("url"), F.struct(f"{ORD}.*", "item").alias(ORD))
    return distinct_supplementary(named.filter(F.col("url").isNotNull()))


def distinct_supplementary(listed: DataFrame) -> DataFrame:
    """Distinct by URL: the first position, the last owner."""
    return listed.groupBy("url").agg(
        F.max_by("geo_accession", ORD).alias("geo_accession"), F.min(ORD).alias(ORD)
    ).select("geo_accession", "url", last_component(F.col("url")).alias("filename"), ORD)


def read_archive_links(spark: SparkSession, path, *, target: str = "sra", strict: bool = True) -> DataFrame:
    """Distinct linked ids of one target archive, in order; none is an error when strict."""
    columns = "DbTo STRING, Link ARRAY<STRUCT<Id: STRING>>, _corrupt STRING"
    parsed = parse_records(read_records(spark, path, "LinkSetDb"), columns)
    ids = parsed.filter(_clean(F.col("r.DbTo")) == target).select(
        ORD, F.posexplode("r.Link.Id").alias("item", "id")
    )
    cleaned = ids.select(_clean(F.col("id")).alias("id"), F.struct(f"{ORD}.*", "item").alias(ORD))
    named = cleaned.filter(F.col("id").isNotNull())
    if strict and named.isEmpty():
        raise ValueError(f"no {target} records are linked")
    return distinct_in_order(named, ["id"])
