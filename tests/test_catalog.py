import hashlib
import json

import csv
import random

import pytest
from pyspark.sql import functions as F

from runloom.operators.catalog import CatalogConflict, RunCatalog, contradictions, first_conflicts, merge_duplicates, merge_few_duplicates
from runloom.ordering import pack_ordered
from runloom.operators.units import accession_sets, unit_fingerprints
from runloom.sources.tables import load_runinfo_pages, read_catalog_csv, read_runinfo, runinfo_violations, read_text_csv

COLUMNS = "Run Experiment BioSample TaxID ScientificName LibraryStrategy LibraryLayout Platform bases size_MB".split() + ["SRA Sample"]
RECORD = dict(zip(COLUMNS, "DRR70 DRX7 SAMD9 4513 Hordeum RNA-Seq SINGLE BGISEQ 1500 20 DRS8".split()))


def records():
    """Two runs of one experiment; the second is half as large."""
    return [RECORD, {**RECORD, "Run": "DRR71", "bases": "750", "size_MB": "10"}]


def test_few_duplicates_are_merged_as_many(spark):
    rows = [(f"R{i}", i, None) for i in range(50)] + [("R1", 1, "x"), ("R2", 7, None), ("R2", None, "y"), (None, 1, None), (None, 1, "z")]
    table = spark.createDataFrame(rows, "Run STRING, n INT, t STRING").withColumn("_ord", F.monotonically_increasing_id())
    few = merge_few_duplicates(table)
    assert few.exceptAll(merge_duplicates(table)).count() == 0 and few.count() == 51
    assert few.filter("Run = 'R2' AND array_contains(_conflicts, 'n')").count() == 1
    # Only the copies of repeated keys are grouped; the other rows pass by a broadcast.
    assert "LeftAnti" in few._jdf.queryExecution().optimizedPlan().toString()


def test_small_groups_are_packed_without_their_sizes(spark):
    packed = pack_ordered(spark.range(9).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"), (-F.col("id")).alias("_ord")), ["k"], "v")
    assert "Join" not in packed._jdf.queryExecution().optimizedPlan().toString()
    assert {r["k"]: (list(r["values"]), r["chunk"], r["n_chunks"]) for r in packed.collect()} == {0: (["8", "6", "4", "2", "0"], 0, 1), 1: (["7", "5", "3", "1"], 0, 1)}


def test_filter_and_units(spark):
    catalog = RunCatalog.from_records(spark, records())
    kept = catalog.filter(F.col("LibraryStrategy") == "RNA-Seq", description="assay").filter(
        lambda row: float(row["size_MB"]) >= 5, description="size"
    )
    units = kept.processing_units(by="experiment")
    unit = units.table.first()
    assert (unit["unit_id"], unit["taxid"], unit["total_bases"], unit["total_size_gb"]) == ("DRX7", 4513, 2250, 0.03)
    packed = {r["kind"]: list(r["values"]) for r in units.packed().collect()}
    assert packed["run_accessions"] == ["DRR70", "DRR71"] and packed["platform"] == ["BGISEQ"]
    sizes = {r["run"]: r["size_gb"] for r in units.run_sizes.collect()}
    assert sizes == {"DRR70": 0.02, "DRR71": 0.01}
    assert kept.audit_with_counts()[-1].endswith("2 -> 2 rows")


def test_duplicates(spark):
    rows = records()
    assert RunCatalog.from_records(spark, [*rows, rows[0]]).deduplicate_runs().frame.count() == 2
    with pytest.raises(CatalogConflict, match="bases"):
        RunCatalog.from_records(spark, [*rows, rows[0] | {"bases": "1501"}]).deduplicate_runs()


def test_null_coalescing_and_order(spark):
    rows = [
        RECORD | {"Run": "B", "Platform": None}, RECORD | {"Run": "A"}, RECORD | {"Run": "B", "bases": None},
    ]
    merged = RunCatalog.from_records(spark, rows).deduplicate_runs()
    assert [r["Run"] for r in merged.frame.orderBy("_ord").collect()] == ["B", "A"]
    assert [r["Platform"] for r in merged.frame.collect()] == ["BGISEQ"] * 2
    assert merged.columns == list(RECORD)


def test_only_run_column(spark):
    catalog = RunCatalog.from_records(spark, [{"Run": "A"}, {"Run": "A"}, {"Run": "B"}])
    assert catalog.deduplicate_runs().frame.count() == 2


def test_ten_conflicts_in_report(spark):
    rows = [RECORD | {"Run": f"R{i:02d}", "bases": str(b)} for i in range(15) for b in (1, 2)]
    merged = merge_duplicates(RunCatalog.from_records(spark, rows).frame)
    found = first_conflicts(merged).collect()
    assert [r["Run"] for r in found] == [f"R{i:02d}" for i in range(10)]
    assert {r["columns"] for r in found} == {"bases"}


def test_transform(spark):
    catalog = RunCatalog.from_records(spark, records())
    changed = catalog.transform(lambda df: df.filter("Run = 'DRR71'").withColumn("x", F.lit(1)), description="one run")
    assert changed.audit_with_counts()[-1] == "transform one run: 2 -> 1 rows"
    with pytest.raises(TypeError):
        catalog.transform(lambda df: 5)
    with pytest.raises(ValueError):
        catalog.transform(lambda df: df.drop("Run"))
    with pytest.raises(TypeError):
        catalog.transform("no function")
    with pytest.raises(TypeError):
        catalog.filter(5)


def test_select_keeps_run(spark):
    catalog = RunCatalog.from_records(spark, records())
    assert catalog.select("bases").columns == ["Run", "bases"]
    assert catalog.with_columns(gb=F.col("size_MB") / 1000).audit[-1] == "added/updated columns"


def test_species_conflict_and_key_fallback(spark):
    mixed = [RECORD, RECORD | {"Run": "DRR71", "TaxID": "4530"}]
    with pytest.raises(CatalogConflict):
        RunCatalog.from_records(spark, mixed).processing_units()
    loose = [RECORD | {"Experiment": ""}, RECORD | {"Run": "DRR71", "Experiment": None}]
    units = RunCatalog.from_records(spark, loose).processing_units().table
    assert {r["unit_id"] for r in units.collect()} == {"DRR70", "DRR71"}
    renamed = [{**{k: v for k, v in RECORD.items() if k != "SRA Sample"}, "Sample": "SRS7"}]
    assert RunCatalog.from_records(spark, renamed).processing_units(by="sra_sample").table.first()["unit_id"] == "SRS7"
    with pytest.raises(ValueError):
        RunCatalog.from_records(spark, [{"Run": "A"}]).processing_units(by="biosample")


def test_normalized_entities(spark):
    views = RunCatalog.from_records(spark, records()).normalized_entities()
    assert set(views) == {"runs", "experiments", "sra_samples", "biosamples"}
    assert views["experiments"].first()["Run"] == "DRR70"


def set_text(accessions):
    accessions = list(accessions)
    limbs = [0] * 4
    for digest in (hashlib.sha256(a.encode()).hexdigest() for a in accessions):
        limbs = [x ^ int(digest[15 * i : 15 * i + 15], 16) for i, x in enumerate(limbs)]
    return f"set:{len(accessions)}:" + "".join(f"{x:015x}" for x in limbs)


def test_hot_unit_is_chunked_without_loss(spark):
    rows = [RECORD | {"Run": f"R{i:03d}"} for i in range(250)] + [RECORD | {"Run": "Z", "Experiment": "SRX2"}]
    units = RunCatalog.from_records(spark, rows).processing_units()
    packed = units.packed(limit=40).filter("kind = 'run_accessions'").collect()
    hot = [r for r in packed if r["unit_id"] == "DRX7"]
    assert len(hot) > 1 and {r["n_chunks"] for r in hot} == {7}
    assert sorted(v for r in hot for v in r["values"]) == [f"R{i:03d}" for i in range(250)]
    ordered = sorted(hot, key=lambda r: r["chunk"])
    assert [len(r["values"]) for r in ordered] == [40] * 6 + [10]
    assert [v for r in ordered for v in r["values"]] == [f"R{i:03d}" for i in range(250)]
    sets = {r["unit_id"]: r for r in accession_sets(units.members).collect()}
    assert sets["DRX7"]["run_accessions"] == [set_text(f"R{i:03d}" for i in range(250))]
    assert sets["SRX2"]["run_accessions"] == [set_text(["Z"])]


def test_fingerprint_equals_canonical_json(spark):
    units = RunCatalog.from_records(spark, records()).processing_units(by="biosample")
    found = unit_fingerprints(
        units.table, accession_sets(units.members), group_by="biosample", processor_identity="p:é", fastq_identity=F.lit("x")
    ).first()
    identity = {
        "group_by": "biosample", "unit_id": "SAMD9", "run_accessions": [set_text(["DRR70", "DRR71"])], "experiment_accessions": [set_text(["DRX7"])],
        "sra_sample_accessions": [set_text(["DRS8"])], "biosample_accessions": [set_text(["SAMD9"])], "taxid": 4513, "genome_pin": None,
        "processor_identity": "p:é", "description_identity": None, "fastq_identity": "x",
    }
    text = json.dumps(identity, sort_keys=True, separators=(",", ":"))
    assert found["fingerprint"] == hashlib.sha256(text.encode()).hexdigest()


def test_csv_catalog(spark, tmp_path):
    path = tmp_path / "runs.csv"
    path.write_text(
        "Run,Experiment,TaxID,ScientificName,size_MB,ReleaseDate,Note\n"
        "SRR1,SRX1,9606,Homo sapiens,1.5,2020-01-02,NA\nSRR2,SRX1,9606,\"Homo, sapiens\",N/A,null,None\nSRR3,,,,,,\n"
    )
    table = read_catalog_csv(spark, str(path))
    kinds = dict(table.drop("_ord").dtypes)
    assert kinds == {
        "Run": "string", "Experiment": "string", "TaxID": "bigint", "ScientificName": "string",
        "size_MB": "double", "ReleaseDate": "date", "Note": "string",
    }
    assert table.filter("Note IS NULL AND Run IN ('SRR1','SRR2','SRR3')").count() == 3
    unit = RunCatalog.from_csv(spark, str(path)).filter("Run = 'SRR1'").processing_units().table.first()
    assert unit["total_size_gb"] == 0.0015


def test_runinfo(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_bytes("﻿Run,Experiment,Sample,SRAStudy,BioSample\nSRR1,SRX1,SRS1,SRP1,SAMN1\n,SRX2,SRS2,SRP1,SAMN2\n".encode())
    row = read_runinfo(spark, str(good)).collect()
    assert len(row) == 1 and (row[0]["SRA Sample"], row[0]["SRA Study"]) == ("SRS1", "SRP1")
    bad = tmp_path / "bad.csv"
    bad.write_text("Run,Sample,SRA Sample\nSRR1,SRS1,SRS2\nSRR2,SRS1,\n")
    assert [r["key"] for r in runinfo_violations(read_text_csv(spark, str(bad))).collect()] == ["SRR1"]
    with pytest.raises(ValueError):
        read_runinfo(spark, str(bad))
    headless = tmp_path / "none.csv"
    headless.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        read_runinfo(spark, str(headless))
    assert load_runinfo_pages(spark, [str(good), str(good)]).frame.count() == 1


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_splits_of_a_file_equal_the_whole(spark, tmp_path, ending):
    """Breaks, quotes and separators in quotes, cut anywhere by twenty and more splits."""
    chance = random.Random(8)
    texts = ["plain", "", 'say "hi"', "two\nlines", 'a,b\n"c"\n\nd', "x" * 90, '"', "\n", "é\n,", " pad "]
    rows = [[f"R{k}", chance.choice(texts), chance.choice(texts), str(k)] for k in range(400)]
    for name, head in (("one.csv", ["Run", "A", "B", "n"]), ("two.csv", ["Run", "B", "A", "extra"])):
        with open(tmp_path / name, "w", newline="", encoding="utf-8-sig") as file:
            csv.writer(file, lineterminator=ending).writerows([head, *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        lines = spark.read.text(str(tmp_path / "one.csv"), lineSep="\n")
        assert lines.select("_metadata.file_block_start").distinct().count() >= 20
        table = read_text_csv(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")])
        got = table.orderBy("_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    clean = lambda v: v or None
    assert [(r["Run"], r["A"] or None, r["B"] or None, r["n"], r["extra"]) for r in got] == [
        (a, clean(b), clean(c), d, None) for a, b, c, d in rows
    ] + [(a, clean(c), clean(b), None, d) for a, b, c, d in rows]


def test_hashes_find_the_conflicts_that_values_show(spark):
    chance = random.Random(2)
    rows = [(f"R{chance.randrange(60)}", chance.choice(["a", "b", None, ""]), chance.choice([1, 2, None]), chance.choice([0.5, None]), k) for k in range(150)]
    table = spark.createDataFrame(rows, "Run STRING, A STRING, `B c` INT, D DOUBLE, _ord INT")
    plain = lambda df: sorted((r["Run"], list(r["_conflicts"])) for r in df.collect())
    found = plain(contradictions(table))
    assert found == plain(merge_duplicates(table).filter(F.size("_conflicts") > 0)) and len(found) > 20
    plan = contradictions(table)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    assert contradictions(table.select("Run", "_ord")).isEmpty() and contradictions(table.limit(0)).isEmpty()


def test_first_rows_carry_what_is_read(spark):
    """The order decides which row is first, but is no part of the row where nobody reads it."""
    from runloom.ordering import keep_first, keep_last

    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k STRING, _ord INT, v STRING")
    assert sorted(tuple(r) for r in keep_first(rows, ["k"]).collect()) == [("a", 1, "y"), ("b", 2, "z")]
    assert sorted(tuple(r) for r in keep_last(rows, ["k"]).collect()) == [("a", 3, "x"), ("b", 2, "z")]
    plan = keep_first(rows, ["k"]).select("k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "_ord, _ord" not in plan


def test_runs_of_a_merged_catalog_are_not_grouped(spark):
    rows = spark.createDataFrame(
        [("r1", "u", "x", 1.0, 1), ("r2", "u", "x", 2.0, 2), ("r3", "w", "y", 3.0, 3)], "Run STRING, BioSample STRING, Experiment STRING, size_MB DOUBLE, _ord INT"
    )
    from runloom.operators import catalog as cat
    from runloom.operators import units as un

    clean = cat.without_conflicts(cat.merge_few_duplicates(rows))
    assert "Join" not in clean._jdf.queryExecution().optimizedPlan().toString()
    for build in (un.unit_run_sizes, un.unit_members):
        plain, unique = build(clean, "BioSample"), build(clean, "BioSample", unique_runs=True)
        assert sorted(map(str, unique.collect())) == sorted(map(str, plain.collect()))
    assert "Aggregate" not in un.unit_run_sizes(clean, "BioSample", unique_runs=True)._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_contradict_by_their_own_bounds(spark):
    from runloom.operators import catalog as cat

    rows = spark.createDataFrame(
        [("a", 1, 2.0, "x", 1), ("a", 1, 2.5, "x", 2), ("b", 1, None, "y", 3), ("b", 1, 1.0, "z", 4), ("c", 4, 1.0, "q", 5)],
        "Run STRING, n INT, size DOUBLE, s STRING, _ord INT",
    )
    found = cat.contradictions(rows)
    assert sorted((r["Run"], list(r["_conflicts"])) for r in found.collect()) == [("a", ["size"]), ("b", ["s"])]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") <= 8


def test_plain_csv_is_numbered_once(spark, tmp_path):
    """Where every line is a record, none has to be joined; headers come from the splits."""
    from runloom.sources.csv_records import read_csv_table

    (tmp_path / "plain.csv").write_text('Run,note\r\nr1,"a, b"\r\nr2,c\r\n')
    (tmp_path / "many.csv").write_text('Run,"no\nte"\nr3,"x\ny"\nr4,z\n')
    plain = read_csv_table(spark, str(tmp_path / "plain.csv"))
    assert [tuple(r)[:2] for r in plain.orderBy("_ord").collect()] == [("r1", "a, b"), ("r2", "c")]
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("MapInArrow") == 1 and "Union" not in text
    many = read_csv_table(spark, str(tmp_path / "many.csv"))
    assert many.columns[:2] == ["Run", "no\nte"]
    assert [tuple(r)[:2] for r in many.orderBy("_ord").collect()] == [("r3", "x\ny"), ("r4", "z")]


def test_first_contradictions_early_late_and_few(spark, monkeypatch):
    """The keys of the first rows suffice where they conflict; late copies count, and in the end all rows do."""
    from runloom.operators import catalog as cat

    monkeypatch.setattr(cat, "FIRST_ROWS", (4, 8))
    schema = "Run STRING, a STRING, n INT, _ord BIGINT"
    for shift, limit in ((0, 3), (20, 3), (0, 12), (35, 9)):
        # Each run has a copy 40 rows later; runs from ``shift`` on differ there.
        rows = [(f"R{i % 40}" if i % 40 else None, "x" if i < 40 or i % 40 < shift else "y", i % 40, i) for i in range(80)]
        table = spark.createDataFrame(rows, schema).repartition(3)
        expected = [tuple(r) for r in first_conflicts(merge_duplicates(table), limit=limit).collect()]
        found = cat.first_contradictions(table, limit=limit)
        assert [tuple(r) for r in found.collect()] == expected and len(expected) == min(limit, 40 - shift)
        if shift == 0 and limit == 3:
            # The whole table is not grouped for the result.
            assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_units_are_packed_from_rows_brought_together_once(spark):
    """As by way of their members, with ties, gaps and units above the limit, and by one shuffle."""
    from runloom.operators import units as un

    draw = random.Random(3)
    rows = [
        (f"r{draw.randint(0, 60)}" if draw.random() < 0.95 else None, draw.choice(["u", "v", "w", "x", "y", "", None]), draw.choice(["e1", "e2", "", None]), draw.choice("ABC"), (draw.randint(0, 15), draw.randint(0, 1)))
        for _ in range(300)
    ]
    table = spark.createDataFrame(rows, "Run STRING, BioSample STRING, Experiment STRING, LibraryLayout STRING, _ord STRUCT<a: INT, b: INT>")
    members = un.unit_members(table, "BioSample")
    for limit in (1_000, 40, 7):
        expected = pack_ordered(members, ["unit_id", "kind"], "value", limit=limit).select("unit_id", "kind", "chunk", "n_chunks", "values")
        packed = un.packed_members(table, "BioSample", limit=limit)
        assert sorted(map(str, packed.collect())) == sorted(map(str, expected.collect()))
    plain = table.withColumn("_ord", F.col("_ord.a") * 2 + F.col("_ord.b"))
    assert sorted(map(str, un.packed_members(plain, "BioSample").collect())) == sorted(map(str, un.packed_members(table, "BioSample").collect()))
    plan = un.packed_members(table, "BioSample")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_contradicting_copies_are_kept_apart(spark):
    """Copies that agree are one run, the others stay under names of their own; no row is lost."""
    from runloom.operators.catalog import merge_or_keep_apart

    draw = random.Random(8)
    rows = [(f"r{draw.randint(0, 90)}", draw.choice([1, 1, 2, None]), draw.choice(["x", "x", "y", None]), i) for i in range(160)]
    rows += [(None, 1, "x", 160), (None, 1, "z", 161), *[("copy", 5, "q", 170 + i) for i in range(9)], ("gap", None, "q", 190), ("gap", 3, None, 189)]
    table = spark.createDataFrame(rows, "Run STRING, n INT, t STRING, _ord INT")
    expected, apart = set(), set()
    for run in {r[0] for r in rows}:
        copies = [r for r in rows if r[0] == run]
        n, t = ({r[i] for r in copies} - {None} for i in (1, 2))
        if len(n) < 2 and len(t) < 2:
            expected.add((run, *(n or [None]), *(t or [None]), min(r[3] for r in copies)))
            continue
        for one in {r[1:3] for r in copies}:
            name = "-".join(str(v) for v in (run, *one) if v is not None)
            apart.add((name, *one, min(r[3] for r in copies if r[1:3] == one)))
    # Names of the test skip nulls, as concat_ws does, so rows that differ only there need a mark.
    own = F.concat_ws("-", "Run", "n", "t")
    marked = F.concat_ws("-", own, F.when(F.col("n").isNull(), "n?"), F.when(F.col("t").isNull(), "t?"))
    found = [tuple(r) for r in merge_or_keep_apart(table, marked).collect()]
    unmarked = {(n.replace("-n?", "").replace("-t?", "") if n else n, *rest) for n, *rest in found}
    assert len(found) == len(unmarked) == len(expected | apart) and {(n or "", *r) for n, *r in unmarked} == {(n or "", *r) for n, *r in expected | apart}
    assert ("copy", 5, "q", 170) in expected and ("gap", 3, "q", 189) in expected and len(apart) > 40
    plan = merge_or_keep_apart(table, marked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


UNITS = ["unit_summaries", "unit_members", "unit_species_conflicts", "unit_run_sizes", "oversized_runs", "unit_fingerprints", "execution_digest"]


@pytest.mark.parametrize("name", UNITS)
def test_units_judge_runs_by_accession_and_keep_all_lines(name):
    """The SQL names agreeing runs by order and line, and no line of a contradicting run is left out."""
    import duckdb

    from runloom.plans import ORACLES

    assert "CASE WHEN Run IN (SELECT Run FROM K) THEN Own ELSE Run END" in ORACLES[name]
    tables = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for table in ("lineitem", "supplier", "nation"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    runs = ORACLES[name][: ORACLES[name].index("CC AS (") + len("CC AS (SELECT * FROM R WHERE rn = 1)")]
    named = database.execute(runs + " SELECT count(*), count(*) FILTER (Run = l_orderkey || '-' || l_linenumber) FROM CC").fetchone()
    lines, single = database.execute("SELECT sum(n), count(*) FILTER (n = 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)").fetchone()
    assert named == (lines, single) and single < lines
