"""Fixed column types of the metadata collections."""

from __future__ import annotations

from pyspark.sql import types as T

ATTRIBUTE = "STRUCT<name: STRING, value: STRING, units: STRING, properties: MAP<STRING, STRING>>"
IDENTIFIER = (
    "STRUCT<kind: STRING, value: STRING, namespace: STRING, label: STRING, is_primary: STRING>"
)
LINK = (
    "STRUCT<type: STRING, database: STRING, id: STRING, label: STRING, url: STRING,"
    " value: STRING, attrs: MAP<STRING, STRING>>"
)
MEMBER = (
    "STRUCT<accession: STRING, member_name: STRING, sample_name: STRING, sample_title: STRING,"
    " spots: STRING, bases: STRING, tax_id: STRING, organism: STRING,"
    f" identifiers: ARRAY<{IDENTIFIER}>, biosample: STRING, geo: STRING>"
)
CONTACT = "STRUCT<first_name: STRING, last_name: STRING, email: STRING>"
RUN_FILE = (
    "STRUCT<attrs: MAP<STRING, STRING>, alternatives: ARRAY<MAP<STRING, STRING>>>"
)
ATTRIBUTES = f"attributes MAP<STRING, ARRAY<STRING>>, attribute_records ARRAY<{ATTRIBUTE}>"

COLLECTIONS = {
    "packages": (
        "accession STRING, experiment_accession STRING, study_accession STRING,"
        " sra_sample_accession STRING, submission_accession STRING,"
        f" run_accessions ARRAY<STRING>, members ARRAY<{MEMBER}>,"
        " totals STRUCT<runs: BIGINT, spots: BIGINT, bases: BIGINT, size_gb: DOUBLE>"
    ),
    "runs": (
        f"accession STRING, alias STRING, identifiers ARRAY<{IDENTIFIER}>, title STRING,"
        " experiment_accession STRING, experiment_refname STRING, spots BIGINT, bases BIGINT,"
        " size_gb DOUBLE, published_at STRING, loaded STRING, is_public STRING,"
        f" cluster_name STRING, members ARRAY<{MEMBER}>, files ARRAY<{RUN_FILE}>,"
        f" statistics STRUCT<reads: BIGINT, spots: BIGINT>, {ATTRIBUTES}, raw STRING"
    ),
    "experiments": (
        f"accession STRING, alias STRING, identifiers ARRAY<{IDENTIFIER}>, title STRING,"
        " study_accession STRING, sample_accession STRING, design_description STRING,"
        " library STRUCT<name: STRING, strategy: STRING, source: STRING, selection: STRING,"
        " layout: STRING, layout_properties: MAP<STRING, STRING>, construction_protocol: STRING>,"
        f" platform STRUCT<name: STRING, instrument_model: STRING>, links ARRAY<{LINK}>,"
        f" {ATTRIBUTES}, raw STRING"
    ),
    "sra_samples": (
        f"accession STRING, alias STRING, identifiers ARRAY<{IDENTIFIER}>, biosample STRING,"
        " geo STRING, title STRING, organism STRING, taxid STRING,"
        f" links ARRAY<{LINK}>, {ATTRIBUTES}, raw STRING"
    ),
    "studies": (
        "accession STRING, alias STRING, center_name STRING,"
        f" identifiers ARRAY<{IDENTIFIER}>, bioproject STRING, geo STRING, title STRING,"
        " type STRING, abstract STRING, center_project_name STRING,"
        f" links ARRAY<{LINK}>, pubmed_ids ARRAY<STRING>, {ATTRIBUTES}, raw STRING"
    ),
    "submissions": (
        "accession STRING, alias STRING, broker_name STRING, center_name STRING,"
        f" lab_name STRING, comment STRING, identifiers ARRAY<{IDENTIFIER}>,"
        " organization STRUCT<type: STRING, name: STRING, abbreviation: STRING,"
        f" contacts: ARRAY<{CONTACT}>>, raw STRING"
    ),
    "biosamples": (
        "accession STRING, id STRING, access STRING, publication_date STRING,"
        " last_update STRING, submission_date STRING,"
        f" identifiers ARRAY<{IDENTIFIER}>, sra_sample STRING, geo STRING, title STRING,"
        f" comment STRING, organism STRING, taxid STRING, owner STRUCT<name: STRING, contacts: ARRAY<{CONTACT}>>,"
        " models ARRAY<STRING>, package STRUCT<name: STRING, display_name: STRING>,"
        f" {ATTRIBUTES}, links ARRAY<{LINK}>, status MAP<STRING, STRING>, raw STRING"
    ),
    "raw_sra_packages": "experiment_accession STRING, raw STRING",
}


def struct_type(collection: str) -> T.StructType:
    """Column types of one collection, with the hidden order column at the end."""
    return T.StructType.fromDDL(COLLECTIONS[collection])
