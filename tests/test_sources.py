import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from runloom.operators import genomes as gn
from runloom.operators import reads as rd
from runloom.sources import archive_xml as ax
from runloom.sources.assemblies import read_reports
from runloom.sources.bundles import collections_from_document, load_bundle, save_bundle, save_ndjson, shape_violations
from runloom.sources.fasta import chromosome_sizes, fasta_violations, write_sizes
from runloom.sources.files import hashed_inventory, read_manifests
from runloom.sources.qc import read_qc_summaries
from runloom.operators.bundle import Bundle
from runloom.streaming.metadata_loads import MetadataLoad


def node(tag, *children, **attributes):
    """XML text of an element; attribute values come quoted, children are texts or elements."""
    opened = " ".join([tag, *[f"{k}={v}" for k, v in attributes.items()]])
    return f"<{opened}>{''.join(children)}</{tag}>"


def q(value):
    return f'"{value}"'


def ids(primary, **external):
    listed = "".join(node("EXTERNAL_ID", v, namespace=q(k)) for k, v in external.items())
    return node("IDENTIFIERS", node("PRIMARY_ID", primary), listed)


def tagged(kind, *records):
    return node(f"{kind}_ATTRIBUTES", *[node(f"{kind}_ATTRIBUTE", node("TAG", t), node("VALUE", v), *[node("UNITS", x) for x in u]) for t, v, *u in records])


def package(experiment, runs, layout="<PAIRED NOMINAL_LENGTH='180' ORIENTATION=\"5&apos;3&apos;-3&apos;5&apos;\"/>", title="Roots &amp; leaves"):
    """A package of an invented barley study: one experiment and two runs."""
    library = node(
        "LIBRARY_DESCRIPTOR", node("LIBRARY_NAME", "plate 4"), node("LIBRARY_STRATEGY", "RNA-Seq"), node("LIBRARY_SOURCE", "TRANSCRIPTOMIC"),
        node("LIBRARY_SELECTION", "cDNA"), node("LIBRARY_LAYOUT", layout), node("LIBRARY_CONSTRUCTION_PROTOCOL", "beads, then <i>two</i> washes"),
    )
    design = node("DESIGN", node("DESIGN_DESCRIPTION", " drought\n series "), node("SAMPLE_DESCRIPTOR", accession=q("DRS55")), library)
    sample = node(
        "SAMPLE", ids("DRS55", BioSample="SAMD0055", GEO="GSM77"), node("TITLE", "root tip"),
        node("SAMPLE_NAME", node("TAXON_ID", "4513"), node("SCIENTIFIC_NAME", "Hordeum vulgare")), tagged("SAMPLE", ("depth", "12", "cm")),
        accession=q("DRS55"), alias=q("tip"),
    )
    study = node(
        "STUDY", ids("DRP9", BioProject="PRJDB700", GEO="GSE77"),
        node("DESCRIPTOR", node("STUDY_TITLE", "Dry summers"), node("STUDY_TYPE", existing_study_type=q("Transcriptome")), node("STUDY_ABSTRACT", "Barley")),
        node("STUDY_LINKS", node("STUDY_LINK", node("XREF_LINK", node("DB", "PubMed"), node("ID", "555000")))),
        accession=q("DRP9"), center_name=q("Field station"),
    )
    first = node(
        "RUN", node("EXPERIMENT_REF", accession=q(experiment)),
        node("SRAFiles", node("SRAFile", node("Alternatives", url=q("gs://x")), node("Alternatives", url=q("s3://x")), filename=q("x.bam"))),
        node("Statistics", nreads=q(2), nspots=q(40)), accession=q(runs[0]), total_spots=q(40), total_bases=q(800), size=q(250),
    )
    second = node("RUN", accession=q(runs[1]), total_spots=q("many"))
    return "\n".join([
        "<EXPERIMENT_PACKAGE>", node("RUN_SET", first, second, runs=q(2), spots=q(90), bases=q(1800), bytes=q(456)), sample, study,
        node("EXPERIMENT", node("TITLE", title), node("STUDY_REF", accession=q("DRP9")), design,
             node("PLATFORM", node("BGISEQ", node("INSTRUMENT_MODEL", "DNBSEQ-T7"))), tagged("EXPERIMENT", ("plot", "17")), accession=q(experiment), alias=q("plot 17")),
        node("Pool", node("Member", ids("DRS55", BioSample="SAMD0055"), accession=q("DRS55"), spots=q(90))),
        node("SUBMISSION", accession=q("DRA3"), lab_name=q("Soil lab")),
        node("Organization", node("Name", "Field station", abbr=q("FS")), node("Contact", node("Name", node("First", "Ida"), node("Last", "Holm")), email=q("ida@fs")), type=q("institute")),
        "</EXPERIMENT_PACKAGE>",
    ])


def package_file(path, *packages):
    path.write_text('<?xml version="1.0"?>\n<EXPERIMENT_PACKAGE_SET>' + "\n".join(packages) + "</EXPERIMENT_PACKAGE_SET>")


FIRST = package("DRX1", ["DRR10", "DRR11"])
SECOND = package("DRX2", ["DRR12", "DRR13"], layout="<SINGLE/>")


def test_packages(spark, tmp_path):
    package_file(tmp_path / "p.xml", FIRST, SECOND)
    bundle = ax.read_packages(spark, str(tmp_path / "p.xml"), include_raw=True)
    relation = bundle.packages.filter("accession = 'DRX1'").first()
    assert relation["run_accessions"] == ["DRR10", "DRR11"]
    assert relation["totals"].asDict() == {"runs": 2, "spots": 90, "bases": 1800, "size_gb": 4.56e-7}
    assert relation["members"][0]["biosample"] == "SAMD0055"
    study = bundle.studies.collect()
    assert len(study) == 1 and (study[0]["bioproject"], study[0]["pubmed_ids"]) == ("PRJDB700", ["555000"])
    libraries = {r["accession"]: r["library"] for r in bundle.experiments.collect()}
    assert libraries["DRX1"]["layout"] == "PAIRED"
    assert libraries["DRX1"]["layout_properties"] == {"NOMINAL_LENGTH": "180", "ORIENTATION": "5'3'-3'5'"}
    assert libraries["DRX2"]["layout"] == "SINGLE" and libraries["DRX2"]["layout_properties"] == {}
    assert libraries["DRX1"]["construction_protocol"] == "beads, then two washes"
    experiment = bundle.experiments.filter("accession = 'DRX1'").first()
    assert experiment["title"] == "Roots & leaves" and experiment["design_description"] == "drought series"
    assert experiment["platform"].asDict() == {"name": "BGISEQ", "instrument_model": "DNBSEQ-T7"}
    assert experiment["attributes"] == {"plot": ["17"]}
    assert json.loads(experiment["raw"])["@attributes"]["accession"] == "DRX1"
    sample = bundle.sra_samples.first()
    assert (sample["biosample"], sample["geo"], sample["taxid"], sample["organism"]) == ("SAMD0055", "GSM77", "4513", "Hordeum vulgare")
    assert sample["attributes"] == {"depth": ["12 cm"]}
    runs = {r["accession"]: r for r in bundle.runs.collect()}
    first = runs["DRR10"]
    assert (first["spots"], first["bases"], first["size_gb"], first["statistics"]["reads"]) == (40, 800, 2.5e-7, 2)
    assert [a["url"] for a in first["files"][0]["alternatives"]] == ["gs://x", "s3://x"]
    assert runs["DRR11"]["spots"] is None and json.loads(runs["DRR11"]["raw"])["@attributes"]["accession"] == "DRR11"
    submission = bundle.submissions.first()
    assert submission["organization"]["name"] == "Field station" and submission["organization"]["contacts"][0]["last_name"] == "Holm"
    raw = json.loads(bundle.raw_sra_packages.filter("experiment_accession = 'DRX1'").first()["raw"])
    assert raw["SAMPLE"]["TITLE"]["#text"] == "root tip" and len(raw["RUN_SET"]["RUN"]) == 2


@pytest.mark.parametrize("broken", [FIRST.replace("</TITLE>", "", 1), FIRST[: FIRST.index("<SUBMISSION")]])
def test_malformed_or_cut_xml(spark, tmp_path, broken):
    (tmp_path / "bad.xml").write_text('<?xml version="1.0"?>\n<EXPERIMENT_PACKAGE_SET>' + SECOND + broken)
    with pytest.raises(ValueError, match="malformed"):
        ax.read_packages(spark, str(tmp_path / "bad.xml"))
    kept = ax.read_packages(spark, str(tmp_path / "bad.xml"), strict=False)
    assert [r["accession"] for r in kept.experiments.collect()] == ["DRX2"]


BIOSAMPLES = "\n".join([
    "<BioSampleSet>",
    node(
        "BioSample", node("Ids", node("Id", "SAMD0055", db=q("BioSample")), node("Id", "DRS55", db=q("SRA"))),
        node("Description", node("Title", "tip"), node("Comment", node("Paragraph", "dug at noon")), node("Organism", taxonomy_id=q(4513), taxonomy_name=q("Hordeum vulgare"))),
        node("Attributes", node("Attribute", "root", attribute_name=q("organ")), node("Attribute", "root cap", attribute_name=q("Organ"), harmonized_name=q("organ"))),
        node("Owner", node("Name", "FS"), node("Contacts", node("Contact", node("Name", node("First", "Ida"), node("Last", "Holm")), email=q("ida@fs")))),
        node("Models", node("Model", "Plant")), node("Package", "Plant.1.0", display_name=q("Plant")),
        node("Links", node("Link", "700", type=q("entrez"), target=q("bioproject"))), node("Status", status=q("suppressed"), when=q(2021)),
        accession=q("SAMD0055"), id=q(55),
    ),
    node("BioSample", node("Status", status=q("again")), accession=q("SAMD0055")),
    '<BioSample id="none"/>',
    "</BioSampleSet>",
])


def test_biosamples(spark, tmp_path):
    (tmp_path / "b.xml").write_text(BIOSAMPLES)
    rows = ax.read_biosamples(spark, str(tmp_path / "b.xml")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row["attributes"] == {"organ": ["root", "root cap"]} and row["status"]["status"] == "suppressed"
    assert (row["sra_sample"], row["comment"], row["models"], row["organism"]) == ("DRS55", "dug at noon", ["Plant"], "Hordeum vulgare")
    assert row["owner"]["contacts"][0]["email"] == "ida@fs" and row["package"]["display_name"] == "Plant"
    assert row["links"][0]["attrs"]["target"] == "bioproject"


def test_supplementary_and_links(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        '<MINiML><Sample iid="GSM1"><Supplementary-Data type="BW">ftp://h/a/x.bw</Supplementary-Data><Supplementary-Data>ftp://h/y.txt.gz\n</Supplementary-Data></Sample>'
        '<Series iid="GSE1"><Supplementary-Data>ftp://h/a/x.bw</Supplementary-Data></Series></MINiML>'
    )
    rows = ax.read_supplementary(spark, str(tmp_path / "f.xml")).orderBy("_ord").collect()
    assert [(r["geo_accession"], r["filename"]) for r in rows] == [("GSE1", "x.bw"), ("GSM1", "y.txt.gz")]
    (tmp_path / "l.xml").write_text(
        "<eLinkResult><LinkSet><LinkSetDb><DbTo>sra</DbTo><Link><Id>5</Id></Link><Link><Id>4</Id></Link><Link><Id>5</Id></Link></LinkSetDb>"
        "<LinkSetDb><DbTo>gds</DbTo><Link><Id>9</Id></Link></LinkSetDb></LinkSet></eLinkResult>"
    )
    assert [r["id"] for r in ax.read_archive_links(spark, str(tmp_path / "l.xml")).orderBy("_ord").collect()] == ["5", "4"]


def test_fasta(spark, tmp_path):
    body = ">chr1 first\nACGT\n\nAC\n>chr2\n" + "A" * 80 + "\n" + ("C" * 60 + "\n") * 2000 + ">chr3\n\n"
    (tmp_path / "g.fa").write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        sizes = chromosome_sizes(spark, str(tmp_path / "g.fa")).orderBy("position").collect()
        assert [(r["name"], r["size"]) for r in sizes] == [("chr1", 6), ("chr2", 80 + 120_000), ("chr3", 0)]
        with gzip.open(tmp_path / "h.fa.gz", "wt") as handle:
            handle.write(body)
        assert chromosome_sizes(spark, str(tmp_path / "h.fa.gz")).count() == 3
        (tmp_path / "bad.fa").write_text("ACGT\n>x\nA\n")
        (tmp_path / "empty.fa").write_text("\n")
        (tmp_path / "nothing.fa").write_bytes(b"")
        found = {r["key"].rsplit("/", 1)[1]: r["detail"] for r in fasta_violations(spark, str(tmp_path / "*.fa")).collect()}
        assert found == {"bad.fa": "sequence before header", "empty.fa": "no sequences", "nothing.fa": "no sequences"}
        write_sizes(chromosome_sizes(spark, str(tmp_path / "g.fa")), str(tmp_path / "sizes"))
        assert spark.read.text(str(tmp_path / "sizes")).filter("value = 'chr1\t6'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


REPORT = {
    "accession": "GCF_1", "organism": {"tax_id": 9606, "organism_name": "Homo sapiens"}, "source_database": "REFSEQ",
    "assembly_info": {"assembly_level": "Chromosome", "assembly_status": "current", "warnings": ["Atypical genome"], "release_date": "2020"},
    "assembly_stats": {"contig_n50": "12", "scaffold_n50": 30, "total_sequence_length": "99"},
}


def test_reports(spark, tmp_path):
    (tmp_path / "taxon-9606.json").write_text(json.dumps({"reports": [REPORT, {"x": [{"accession": "GCF_2", "assembly_info": {"a": 1}}]}]}, indent=1))
    rows = gn.candidates_from_reports(read_reports(spark, str(tmp_path / "taxon-9606.json"), lines=False), "requested_taxid").collect()
    first = next(r for r in rows if r["accession"] == "GCF_1")
    assert (first["taxid"], first["contig_n50"], first["scaffold_n50"], first["total_length"]) == (9606, 12, 30, 99)
    assert first["atypical"] and first["warnings"] == ["Atypical genome"] and first["requested_taxid"] == 9606
    assert len(rows) == 2
    (tmp_path / "taxon-1.jsonl").write_text(json.dumps(REPORT | {"assembly_info": {"warnings": "fine", "atypical": False}}) + "\n\n" + json.dumps(REPORT) + "\n")
    lines = gn.candidates_from_reports(read_reports(spark, str(tmp_path / "taxon-1.jsonl"))).collect()
    assert sorted(r["atypical"] for r in lines) == [False, True] and ["fine"] in [r["warnings"] for r in lines]


def test_inventory_and_read_sets(spark, tmp_path):
    (tmp_path / "a.fq").write_bytes(b"abc")
    (tmp_path / "z.fq").write_bytes(b"")
    files = hashed_inventory(spark, str(tmp_path), glob="*.fq")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.collect()}
    assert rows["a.fq"]["sha256"] == hashlib.sha256(b"abc").hexdigest() and "z.fq" not in rows
    good = hashlib.sha256(b"abc").hexdigest()
    path, empty = str(tmp_path / "a.fq"), str(tmp_path / "z.fq")
    manifests = spark.createDataFrame(
        [("ok", "single", [], [], [path], {path: good}), ("sum", "single", [], [], [path], {path: "bad"}),
         ("name", "single", [], [], [path], {"/other": good}), ("empty", "single", [], [], [empty], {}), ("layout", "paired", [], [], [path], {})],
        "unit_id STRING, layout STRING, read1 ARRAY<STRING>, read2 ARRAY<STRING>, single ARRAY<STRING>, checksums MAP<STRING,STRING>",
    )
    assert {r["unit_id"] for r in rd.valid_read_sets(manifests, files).filter("valid").collect()} == {"ok"}
    (tmp_path / "m").mkdir()
    (tmp_path / "m/1.json").write_text(json.dumps({"unit_id": "ok", "layout": "single", "single": [path], "checksums": {path: good}}, indent=1))
    (tmp_path / "m/2.json").write_text("{ no manifest")
    (tmp_path / "m/3.json").write_text(json.dumps({"unit_id": "twice", "layout": "single", "single": [path, path], "checksums": None}))
    found = rd.valid_read_sets(read_manifests(spark, str(tmp_path / "m")), files).collect()
    assert {r["unit_id"]: r["valid"] for r in found} == {"ok": True, None: False, "twice": True}


def test_qc_reports(spark, tmp_path):
    def report(before, after, **lengths):
        return json.dumps({"summary": {"before_filtering": {"total_reads": before, **lengths}, "after_filtering": {"total_reads": after}}}, indent=1)

    (tmp_path / "p.json").write_text(report(10, 9, read1_mean_length=5, read2_mean_length=6))
    (tmp_path / "s.json").write_text(report(10, 11, read1_mean_length=5))
    (tmp_path / "e.json").write_text("{}")
    reasons = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in read_qc_summaries(spark, str(tmp_path / "*.json")).collect()}
    assert reasons == {"p.json": None, "s.json": "non-positive or inconsistent counts", "e.json": "required field is missing"}


def test_bundle_round_trip(spark, tmp_path):
    package_file(tmp_path / "p.xml", FIRST)
    bundle = ax.read_packages(spark, str(tmp_path / "p.xml"))
    save_bundle(bundle, str(tmp_path / "saved"))
    again = load_bundle(spark, str(tmp_path / "saved"))
    assert again.runs.count() == 2 and again.biosamples.count() == 0
    save_ndjson(bundle, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines/runs.ndjson")).count() == 2
    (tmp_path / "m.json").write_text(json.dumps({"runs": [{"accession": "R1", "spots": 3}], "packages": [{"accession": "X", "run_accessions": ["R1"]}]}))
    document = collections_from_document(spark, str(tmp_path / "m.json"))
    (tmp_path / "a.json").write_text(json.dumps({
        "sra_samples": [{"accession": "S1", "attributes": {"organ": ["root", "cap"], "age": "4"}}],
        "raw_sra_packages": [{"experiment_accession": "X", "raw": {"EXPERIMENT": {"#text": "t"}}}],
    }))
    listed = collections_from_document(spark, str(tmp_path / "a.json"))
    assert listed.sra_samples.first()["attributes"] == {"organ": ["root", "cap"], "age": ["4"]}
    assert json.loads(listed.raw_sra_packages.first()["raw"]) == {"EXPERIMENT": {"#text": "t"}}
    assert document.runs.first()["spots"] == 3 and document.packages.first()["run_accessions"] == ["R1"] and document.studies.count() == 0
    (tmp_path / "w.json").write_text(json.dumps({"runs": {"a": 1}}))
    assert [r["key"] for r in shape_violations(spark, str(tmp_path / "w.json")).collect()] == ["runs"]
    assert shape_violations(spark, str(tmp_path / "m.json")).count() == 0


def test_incremental_load(spark, tmp_path):
    packages, samples = tmp_path / "packages", tmp_path / "samples"
    packages.mkdir()
    samples.mkdir()
    load = MetadataLoad(spark, str(tmp_path / "cumulative"))

    def run(checkpoint):
        load.load_packages(str(packages), str(tmp_path / checkpoint)).awaitTermination()

    def titles():
        return [(r["accession"], r["title"]) for r in load.current().experiments.orderBy("_ord").collect()]

    package_file(packages / "1.xml", FIRST)
    run("cp")
    assert titles() == [("DRX1", "Roots & leaves")]
    assert {r["experiment_accession"]: r["complete"] for r in load.index().collect()} == {"DRX1": False}
    package_file(packages / "2.xml", SECOND, FIRST.replace("Roots", "Stems"))
    run("cp")
    both = [("DRX1", "Stems & leaves"), ("DRX2", "Roots & leaves")]
    assert titles() == both
    (samples / "b.xml").write_text(BIOSAMPLES)
    load.load_biosamples(str(samples), str(tmp_path / "cp-samples")).awaitTermination()
    assert titles() == both and [r["accession"] for r in load.current().biosamples.collect()] == ["SAMD0055"]
    assert {r["experiment_accession"]: r["complete"] for r in load.index().collect()} == {"DRX1": True, "DRX2": True}
    run("cp")
    (packages / "1.xml").unlink()
    run("another")
    assert sorted(titles()) == both and load.current().biosamples.count() == 1
    load.apply(Bundle(), 0, f"packages:{tmp_path / 'cp'}")
    assert sorted(titles()) == both and isinstance(load.current(), Bundle)
    assert load.current().runs.filter(F.col("accession") == "DRR12").count() == 1


def test_a_family_file_is_not_one_row(spark, tmp_path):
    series = '<Series iid="GSE1"><Title>t</Title><Supplementary-Data>ftp://h/all.tar</Supplementary-Data></Series>'
    samples = [f'<Sample iid="GSM{k}"><Supplementary-Data>ftp://h/{k % 7}.txt</Supplementary-Data><Series-Ref ref="GSE1"/></Sample>' for k in range(500)]
    for name, parts in (("first.xml", [series, *samples]), ("last.xml", [*samples, series])):
        (tmp_path / name).write_text("<MINiML>\n" + "\n".join(parts) + "\n</MINiML>")
        rows = ax.family_records(spark, str(tmp_path / name))
        assert rows.count() == 501 and rows.agg(F.max(F.length("xml"))).first()[0] < 200
        files = {r["filename"]: r["geo_accession"] for r in ax.read_supplementary(spark, str(tmp_path / name)).collect()}
        assert files == {f"{k}.txt": f"GSM{max(n for n in range(500) if n % 7 == k)}" for k in range(7)} | {"all.tar": "GSE1"}


def test_texts_and_references_survive(spark, tmp_path):
    package_file(tmp_path / "p.xml", FIRST.replace("Roots", "loss of &lt;gene&gt; in <i>a</i> &lt;b or c&gt;d &#945; Roots"))
    bundle = ax.read_packages(spark, str(tmp_path / "p.xml"))
    assert bundle.experiments.first()["title"].startswith("loss of <gene> in a <b or c>d \u03b1 Roots")
    kinds = [i["kind"] for df in (bundle.sra_samples, bundle.studies) for r in df.collect() for i in r["identifiers"]]
    assert kinds and all(isinstance(k, str) and not k.isdigit() for k in kinds)
    xml = "<LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH='&#51;00' note=\"a &amp; 'b'\"" + " " * 20_000 + "/></LIBRARY_LAYOUT>"
    read = spark.createDataFrame([(xml,), ("<LIBRARY_LAYOUT><SINGLE/></LIBRARY_LAYOUT>",), (None,)], "xml STRING").select(ax.layout_properties(F.col("xml")).alias("p"))
    assert [r["p"] for r in read.collect()][:2] == [{"NOMINAL_LENGTH": "300", "note": "a & 'b'"}, {}]


def parses(df):
    """How often a plan parses the text of each record."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(")


def test_records_are_parsed_once(spark, tmp_path):
    """Filters on fields of the struct do not parse the text once more."""
    package_file(tmp_path / "p.xml", FIRST, SECOND)
    bundle = ax.read_packages(spark, str(tmp_path / "p.xml"))
    assert parses(bundle.runs.select("accession")) == 1
    assert parses(bundle.experiments.select("accession", "title")) == 2  # the record, and the attributes of its layout
    (tmp_path / "l.xml").write_text("<LinkSetDb><DbTo>sra</DbTo><Link><Id>5</Id></Link></LinkSetDb>")
    assert parses(ax.read_archive_links(spark, str(tmp_path / "l.xml")).select("id")) == 1


def test_text_that_breaks_without_its_tags(spark, tmp_path):
    """Taking out tags may join a ``]]>``, which is not well formed: found by the strict check."""
    package_file(tmp_path / "p.xml", FIRST.replace("</TITLE>", "]]<b></b>></TITLE>", 1))
    with pytest.raises(ValueError, match="malformed"):
        ax.read_packages(spark, str(tmp_path / "p.xml"))


def test_documents_by_lines(spark, tmp_path):
    """Documents of one file are rows of their own, so no task needs the whole file."""
    samples = [{"sra_samples": [{"accession": f"S{i}{j}", "attributes": {"organ": ["root", "cap"] if j else "stem"}} for j in range(2)]} for i in range(3)]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in samples))
    rows = collections_from_document(spark, str(tmp_path / "d.json"), lines=True).sra_samples.orderBy("_ord").collect()
    assert [r["accession"] for r in rows] == ["S00", "S01", "S10", "S11", "S20", "S21"]
    assert [r["attributes"]["organ"] for r in rows[:2]] == [["stem"], ["root", "cap"]]
