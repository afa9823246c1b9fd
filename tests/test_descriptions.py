import pandas as pd
import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from runloom.functions.text import plain_in_jvm, plain_texts, without_markup
from runloom.operators import descriptions as ds
from runloom.operators.bundle import Bundle
from runloom.ordering import ORD, with_order

RECORDS = "ARRAY<STRUCT<name: STRING, value: STRING, units: STRING, properties: MAP<STRING,STRING>>>"


def record(name, value, units=None, properties=None):
    return (name, value, units, properties)


def bundle(spark, packages=None, records=(), biosample_records=(), attributes=None, organism="Mus"):
    def table(rows, schema):
        return with_order(spark.createDataFrame(rows, schema))

    return Bundle(
        packages=table(packages or [("SRX1", "SRX1", "SRP1", "SRS1", "SRA1", ["R1"])],
                       "accession STRING, experiment_accession STRING, study_accession STRING, sra_sample_accession STRING, submission_accession STRING, run_accessions ARRAY<STRING>"),
        runs=table([("R1",)], "accession STRING"),
        experiments=table(
            [("SRX1", "design", ("lib", "ATAC-seq", None, "missing", "PAIRED", {"NOMINAL_LENGTH": "300", "other": "x"}, "p" * 5000), ("ILLUMINA", "HiSeq"), attributes or {})],
            "accession STRING, design_description STRING, library STRUCT<name: STRING, strategy: STRING, source: STRING, selection: STRING, layout: STRING, layout_properties: MAP<STRING,STRING>, construction_protocol: STRING>, platform STRUCT<name: STRING, instrument_model: STRING>, attributes MAP<STRING, ARRAY<STRING>>",
        ),
        sra_samples=table([("SRS1", "SAMN1", organism, {}, list(records))], f"accession STRING, biosample STRING, organism STRING, attributes MAP<STRING, ARRAY<STRING>>, attribute_records {RECORDS}"),
        studies=table([("SRP1", "Study", "Abstract"), ("SRP2", "Other", None)], "accession STRING, title STRING, abstract STRING"),
        submissions=table([("SRA1", ("Center", "GEO"), "center")], "accession STRING, organization STRUCT<name: STRING, abbreviation: STRING>, center_name STRING"),
        biosamples=table([("SAMN1", "from a mouse", {}, list(biosample_records))], f"accession STRING, comment STRING, attributes MAP<STRING, ARRAY<STRING>>, attribute_records {RECORDS}"),
    )


def described(b, policy=None):
    maps = ds.description_maps(ds.compact_descriptions(b, policy))
    rows = maps.select("experiment", F.map_keys("description").alias("k"), F.map_values("description").alias("v")).collect()
    return {r["experiment"]: dict(zip(r["k"], r["v"])) for r in rows}


ATTRIBUTES = [
    record("cell_type", "CD8+ T cell"), record("dev_stage", "embryo"), record("genotype/variation", "WT"), record("treatment", "NO"),
    record("age", "0"), record("phenotype", "not collected"), record("External Id", "SAMEA1"), record("collection_date", "2022-01-01"),
    record("unknown mechanism", "novel state"), record("weight", "4", "g"), record("dose", "4.0", "months"),
    record("odd", "via property", None, {"attribute_name": "strain"}), record("time", "3", None, {"unit": "h"}),
]


def test_selected_fields(spark):
    found = described(bundle(spark, records=ATTRIBUTES))["SRX1"]
    assert {k: found[k] for k in ("Cell type", "Developmental stage", "Genotype", "Treatment", "Age", "Dose", "Strain", "Time")} == {
        "Cell type": ["CD8+ T cell"], "Developmental stage": ["embryo"], "Genotype": ["WT"], "Treatment": ["NO"], "Age": ["0"],
        "Dose": ["4.0 months"], "Strain": ["via property"], "Time": ["3 h"],
    }
    assert not {"Phenotype", "Mechanism", "weight"} & set(found)
    assert found["Submitted by"] == ["Center (GEO)"] and found["Construction protocol"] == ["p" * 5000]
    assert found["Selection"] == ["missing"] and "Source" not in found and found["Insert size"] == ["300"] and found["other"] == ["x"]
    assert found["Sample description"] == ["from a mouse"] and found["ID"] == ["SRX1"] and found["BioSample ID"] == ["SAMN1"]
    assert list(found)[:5] == ["ID", "Experiment ID", "SRA Sample ID", "Species", "BioSample ID"]
    policy = ds.DescriptionPolicy({"Unknown_Mechanism": "Mechanism", "age": "Years"})
    extended = described(bundle(spark, records=ATTRIBUTES), policy)["SRX1"]
    assert extended["Mechanism"] == ["novel state"] and extended["Years"] == ["0"]


def test_folding_and_tissue(spark):
    found = described(bundle(
        spark, records=[record("tissue", "brain  cortex"), record("organ", "[x] Brain cortex"), record("tissue", "liver"), record("source_name", "LIVER")],
        biosample_records=[record("tissue", "[src] Brain cortex")],
    ))["SRX1"]
    assert found["Tissue"] == ["[src] Brain cortex", "liver"] and "Source name" not in found
    kept = described(bundle(spark, records=[record("tissue", "liver"), record("source_name", "LIVER"), record("isolation source", "x")]))["SRX1"]
    assert kept["Source name"] == ["LIVER", "x"]


def test_experiment_attribute_wins_in_place(spark):
    found = described(bundle(
        spark, records=[record("tissue", "liver"), record("source name", "assay")], attributes={"Experimental Factor: Tissue": ["assay", "n/a"], "ID": ["1"]},
    ))["SRX1"]
    assert found["Tissue"] == ["assay", "n/a"] and found["Experiment attribute: ID"] == ["1"] and "Source name" not in found
    assert list(found).index("Tissue") < list(found).index("Sample description")


def test_missing_sample_and_conflict(spark):
    row = ("SRX1", "SRX1", "SRP1", "lost", "SRA1", ["R1"])
    found = described(bundle(spark, packages=[row]))["SRX1"]
    assert found["SRA Sample ID"] == ["lost"] and "Species" not in found and found["Study"] == ["Study"]
    twice = bundle(spark, packages=[("a", "SRX1", "SRP1", "SRS1", "SRA1", ["R1"]), ("b", "SRX1", "SRP2", "SRS1", "SRA1", ["R1"])])
    with pytest.raises(ValueError, match="SRX1"):
        ds.compact_descriptions(twice)
    same = bundle(spark, packages=[("a", "SRX1", "SRP1", "SRS1", "SRA1", ["R1"])] * 2)
    assert len(described(same)) == 1
    with pytest.raises(ValueError):
        ds.describe(same, profile="other")
    assert ds.study_fields(same).filter("field = 'Study'").count() == 1


def test_descriptions_are_brought_together_once(spark):
    records = [record("tissue", "&eacute;pi <b>derm</b>"), record("organ", "[a] \u00c9pi  derm"), record("source name", "\u00e9pi derm"), record("disease", "n/a")]
    b = bundle(spark, records=records, biosample_records=[record("sex", "x"), record("gender", "x"), record("sex", "y")])
    found = described(b)["SRX1"]
    assert found["Tissue"] == ["\u00e9pi derm"] and found["Sex"] == ["x", "y"] and not {"Source name", "Disease"} & set(found)
    apart = [record("tissue", "liver"), record("source name", "liver"), record("isolation source", "bank")]
    assert described(bundle(spark, records=apart))["SRX1"]["Source name"] == ["liver", "bank"]
    maps = ds.description_maps(ds.compact_descriptions(b, strict=False))
    plan = maps._jdf.queryExecution().sparkPlan().toString()
    plan = plan[:plan.index("Generate")]
    # Above the entries there is the one step that brings them together, no join and no stored copy.
    assert "Scan ExistingRDD" not in plan and maps._jdf.queryExecution().executedPlan().toString().split("Generate")[0].count("Exchange hashpartitioning(experiment") == 1


def test_full_profile(spark):
    records, runs = ds.describe(bundle(spark), profile="full")
    row = records.first()
    assert row["experiment"]["library"]["strategy"] == "ATAC-seq" and row["biosample"]["comment"] == "from a mouse"
    assert [r["run"]["accession"] for r in runs.collect()] == ["R1"]
    lost = bundle(spark, packages=[("SRX1", "SRX1", "SRP1", "lost", "SRA1", ["R1"])])
    with pytest.raises(ValueError, match="lost"):
        lost.full_descriptions()


def test_runs_stay_without_a_loaded_sample(spark):
    lost = ("a", "SRX1", "SRP1", "lost", "SRA1", ["R1"])
    records, runs = bundle(spark, packages=[lost]).full_descriptions(strict=False)
    assert records.count() == 0 and [r["run"]["accession"] for r in runs.collect()] == ["R1"]
    loaded = ("b", "SRX1", "SRP1", "SRS1", "SRA1", ["R1", "R1"])
    records, runs = bundle(spark, packages=[lost, loaded]).full_descriptions(strict=False)
    assert records.first()["package_relation"]["accession"] == "b" and runs.count() == 2


MARKUP = {
    '<span class="x">SAMEA6806937</span>': "SAMEA6806937", "CUT&amp;amp;Tag": "CUT&Tag", "A &lt; B": "A < B", "it’s": "it’s",
    "a  b": "a  b", "<b>a</b>  <i>b</i>": "a b", "&lt;p&gt;x&lt;/p&gt;": "x", "": "",
}


def test_markup(spark):
    rows = spark.createDataFrame(list(MARKUP.items()), "raw STRING, expected STRING")
    wrong = rows.withColumn("found", without_markup(F.col("raw"))).filter("NOT found <=> expected").collect()
    assert wrong == []


def test_markup_on_pages_equals_row_by_row(spark):
    class Text(HTMLParser):
        def __init__(self):
            super().__init__()
            self.all = ""

        def handle_data(self, data):
            self.all += data

    def brute(value):
        for _ in range(5):
            value = html.unescape(value)
        parser = Text()
        parser.feed(value)
        parser.close()
        return " ".join(parser.all.split())

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("html", without_markup(F.col("html")).alias("found")).collect()
    assert rows and all(r["found"] == brute(r["html"]) for r in rows)
    assert plain_texts(pd.Series([r["html"] for r in rows])).tolist() == [r["found"] for r in rows]


ODD_MARKUP = [
    "a &eacute; b", "<b title='x>y'>q</b>", "a < b <i>c</i>", "<script>if (a<b) x</script>y", "&amp;amp;amp;amp;amp;amp;amp;lt;", "<!-- c --><i>x</i>",
    "&lt", "x &#945; y", "<p>\x1cone\x1c two</p>", "<i>a\u2003b</i>", "AT&T <b>x</b>", "R&D;", "<a href=x>y</a>", "<>", "</ b>z", "<i", "&&&", "<br><BR/>t", "&nbsp;<i>x</i>&nbsp;",
    "<title>&lt;b&gt;</title>", "<i>1</i" , "5 &gt; 4", "<i a='1\" b>x</i>",
]


def test_markup_in_the_jvm_equals_the_reader(spark):
    given = [*MARKUP, *ODD_MARKUP, None]
    rows = spark.createDataFrame([(v,) for v in given], "raw STRING").select("raw", without_markup(F.col("raw")).alias("found"), plain_in_jvm(F.col("raw")).alias("jvm")).collect()
    expected = dict(zip(given, plain_texts(pd.Series(given, dtype=object)).tolist()))
    for r in rows:
        assert r["found"] == expected[r["raw"]], r
    told = {r["raw"] for r in rows if r["jvm"] is not None}
    assert {"<b>a</b>  <i>b</i>", "A &lt; B", "&&&", "5 &gt; 4"} <= told and not {"a &eacute; b", "a < b <i>c</i>"} & told


def test_identity_of_descriptions(spark):
    maps = ds.description_maps(ds.compact_descriptions(bundle(spark, records=ATTRIBUTES)))
    changed = ds.description_maps(ds.compact_descriptions(bundle(spark, records=ATTRIBUTES, organism="Rattus")))
    one, two = (ds.description_identities(m, "training").first() for m in (maps, changed))
    assert one["profile"] == "training" and len(one["sha256"]) == 64 and one["sha256"] != two["sha256"]
    many = [(f"field {k % 7}", f"value {k}") for k in range(12_000)]
    rows = spark.createDataFrame([("SRX1", f, k % 7, v, k) for k, (f, v) in enumerate(many)], "experiment STRING, field STRING, field_ord INT, value STRING, value_ord INT")
    large = ds.description_maps(rows).collect()
    assert len(large) == 1 and sum(map(len, large[0]["description"].values())) == len(many)
    assert large[0]["description"]["field 3"][:2] == ["value 3", "value 10"]
    assert ds.description_maps(rows).select(F.map_keys("description").alias("k")).first()["k"] == [f"field {k}" for k in range(7)]


def test_linked_subset_keeps_assay_specific_protocol(spark):
    two = bundle(spark, packages=[("SRX1", "SRX1", "SRP1", "SRS1", "SRA1", ["R1"]), ("SRX2", "SRX2", "SRP2", "SRS1", "SRA1", ["R2"])])
    raw = spark.createDataFrame([], f"experiment_accession STRING, raw STRING, {ORD} BIGINT")
    wanted = spark.createDataFrame([("SRX1",)], "experiment_accession STRING")
    part = Bundle(**{**two.__dict__, "raw_sra_packages": raw}).subset_experiments(wanted)
    assert part.runs.count() == 1 and part.experiments.count() == 1 and part.studies.first()["accession"] == "SRP1"


def test_descriptions_are_folded_within_their_link(spark):
    """Random entries of a link, folded in its row, as the row operators fold them."""
    import random

    draw = random.Random(11)
    values = ["liver", "[a] Liver", " LIVER", "brain  cortex", "brain cortex", "x", "STRASSE", "straße", "n/a", "&eacute; <b>x</b>", "é x"]
    rows = [
        (f"E{e}", stage, block, 0, draw.choice(["Tissue", "Source name", "Sex", "Age"]), draw.choice(values), draw.random() < 0.3)
        for e in range(300)
        for stage in (0, 1)
        for block in range(draw.randint(0, 5))
    ]
    table = spark.createDataFrame(rows, "experiment STRING, stage INT, block INT, pos INT, field STRING, value STRING, keep_missing BOOLEAN")
    loose = ds.fold_values(table.withColumn("ord", F.struct("block", "pos")), ["experiment", "stage"])
    repeated = ds.redundant_sources(ds.experiment_wins(loose, ["experiment"]).select(*loose.columns), ["experiment"])
    kept = ds.experiment_wins(loose, ["experiment"]).join(repeated.withColumn("_gone", F.lit(True)), "experiment", "left").filter("_gone IS NULL OR field <> 'Source name'")
    expected = {(r["experiment"], r["field"], r["value"], tuple(r["ord"]), (r["field_ord"]["stage"], *r["field_ord"]["ord"])) for r in kept.collect()}
    entry = F.struct("block", "pos", "field", "value", "keep_missing", *[F.lit(None).cast("string").alias(a) for a in ("alias0", "alias1")])
    lists = table.groupBy("experiment").agg(*[F.collect_list(F.when(F.col("stage") == s, entry)).alias(f"_{s}") for s in (0, 1)])
    ready = ds._ready_entries(lists, None, _a=(0, F.col("_0")), _b=(1, F.col("_1")))
    fields = ready.select("experiment", F.explode(F.array(ds._folded(F.concat("_a", "_b"), drop_sources=True))).alias("f")).select("experiment", F.inline("f"))
    found = {(r["experiment"], r["field"], v["value"], (v["block"], v["pos"]), (r["stage"], r["block"], r["pos"])) for r in fields.collect() for v in r["values"]}
    assert found == expected and len(found) > 600
    long = [record("tissue", f"part {i}") for i in range(4_000)] + [record("source name", "PART 7")]
    maps = ds.compact_maps(bundle(spark, records=long), strict=False)
    assert maps.first()["description"]["Tissue"] == [f"part {i}" for i in range(4_000)] and "Source name" not in maps.first()["description"]
    plan = maps._jdf.queryExecution().executedPlan().toString()
    # Above the joins of the records nothing is sorted, windowed, grouped or exchanged.
    assert not [step for step in ("Window", "Sort ", "Aggregate", "Exchange") if step in plan[:plan.index("Join")]]
