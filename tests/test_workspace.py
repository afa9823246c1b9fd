import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import functions as F

from runloom.operators.catalog import RunCatalog
from runloom.operators.process import ProcessingResult
from runloom.operators.state import FOLD_COLUMNS, final_states, fold_events
from runloom.streaming.unit_states import fold_event_stream
from runloom.workspace import EXECUTIONS, Workspace


def test_build_resume_and_rebuild(spark, tmp_path):
    def processor(fastq, genome, context):
        os.makedirs(context["output_dir"], exist_ok=True)
        with open(os.path.join(context["output_dir"], "x.bw"), "w") as handle:
            handle.write(fastq["text"])
        if fastq["text"] == "bad":
            raise ValueError("no good")
        return ProcessingResult(True, {"coverage": "x.bw"})

    (tmp_path / "g.fa").write_text(">a\nA\n")
    records = [
        {"Run": f"SRR{i}", "Experiment": f"SRX{i}", "SRA Sample": f"SRS{i}", "BioSample": f"SAMN{i}", "TaxID": "9606",
         "ScientificName": "Homo sapiens", "size_MB": "1"} for i in (1, 2, 3)
    ]
    catalog = RunCatalog.from_records(spark, records)

    def inputs(third):
        rows = [(f"SRX{i}", (third if i == 3 else "ok",), ("GCF", str(tmp_path / "g.fa")), (str(tmp_path / f"out/SRX{i}"),)) for i in (1, 2, 3)]
        return spark.createDataFrame(rows, "unit_id STRING, fastq STRUCT<text: STRING>, genome STRUCT<accession: STRING, fasta: STRING>, context STRUCT<output_dir: STRING>")

    workspace = Workspace(spark, str(tmp_path / "w"))

    def build(third="bad", **options):
        name, outcomes = workspace.build(catalog, processor, inputs(third), **options)
        return name, {r["unit_id"]: r["status"] for r in outcomes.collect()}

    first, outcome = build(processor_id="v1")
    assert first.startswith("execution-") and outcome == {"SRX1": "succeeded", "SRX2": "succeeded", "SRX3": "failed"}
    manifest = {r["unit_id"]: r for r in workspace.manifest().collect()}
    assert manifest["SRX1"]["schema_version"] == 3 and manifest["SRX1"]["artifacts"]["coverage"]["size"] == 2
    assert manifest["SRX3"]["status"] == "failed" and "no good" in manifest["SRX3"]["error"]
    _, outcome = build(processor_id="v1")
    assert set(outcome.values()) == {"skipped"}
    (tmp_path / "out/SRX2/x.bw").write_text("tampered")
    second, outcome = build("ok", processor_id="v1", retry_failed=True)
    assert outcome == {"SRX1": "skipped", "SRX2": "succeeded", "SRX3": "succeeded"}
    report = workspace.status()
    units = {r["unit_id"]: r for r in report["units"].collect()}
    assert units["SRX3"]["attempts"] == 2 and units["SRX3"]["error"] is None
    assert {r["status"]: r["n"] for r in report["counts"].collect()}["succeeded"] == 3
    described = spark.createDataFrame([("SRX1", "training", "abc")], "unit_id STRING, profile STRING, sha256 STRING")
    _, outcome = build("ok", processor_id="v1", descriptions=described)
    assert outcome == {"SRX1": "succeeded", "SRX2": "skipped", "SRX3": "skipped"}
    assert workspace.status(second)["units"].count() == 3
    sources = lambda url: spark.createDataFrame([("SRX1", url)], "unit_id STRING, source STRING")
    audits = [r["audit"] for r in workspace.table("executions", EXECUTIONS).collect()]
    assert all(a[0] == "created from records" for a in audits) and len(audits) == 4
    names = [workspace.create_execution(catalog, processor, processor_id="v1", sources=sources(u)) for u in ("ftp://a", "ftp://a", "ftp://b")]
    prints = [{r["unit_id"]: r["fingerprint"] for r in workspace.items(n).collect()} for n in names]
    assert prints[0] == prints[1] and prints[0]["SRX1"] != prints[2]["SRX1"] and prints[0]["SRX2"] == prints[2]["SRX2"]


EVENT = "unit_id STRING, kind STRING, claim_id STRING, fingerprint STRING, payload STRING, ts TIMESTAMP"


def test_states_from_snapshots_equal_the_whole_fold(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "w"))
    assert workspace.states().isEmpty() and workspace.events().isEmpty() and not workspace.take_snapshot()
    rounds = [
        [("a", "claim", "1", "f", None), ("b", "claim", "1", "f", None), ("c", "fail", "9", "f", "x")],
        [("a", "succeed", "1", "f", "{}"), ("b", "phase", "1", "f", "processing"), ("d", "claim", "2", "f", None)],
        [("b", "fail", "0", "f", "late"), ("d", "fail", "2", "f", "no"), ("c", "claim", "3", "g", None)],
        [("a", "claim", "4", "g", None), ("d", "claim", "5", "f", None)],
    ]
    taken = []
    for rows in rounds:
        events = spark.createDataFrame([(*r, datetime(2024, 1, 1)) for r in rows], EVENT)
        assert workspace.append_events(events) == len(taken)
        plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert plain(workspace.states()) == plain(final_states(fold_events(workspace.events())))
        taken.append(workspace.take_snapshot(least_events=3))
        assert plain(workspace.states()) == plain(final_states(fold_events(workspace.events())))
    # The third snapshot knows four units, and two events are too few for a fourth.
    assert taken == [True, True, True, False]
    assert workspace._snapshot()[0] == 3 and {n: e["rows"] for n, e in workspace._states()[2].items()} == {3: 2}


def test_two_builds_never_share_a_number(spark, tmp_path):
    workspaces = [Workspace(spark, str(tmp_path / "w")) for _ in range(2)]
    event = spark.createDataFrame([("a", "claim", "1", "f", None, datetime(2024, 1, 1))], EVENT)

    def append(workspace):
        return [workspace.append_events(event) for _ in range(4)]

    with ThreadPoolExecutor(2) as pool:
        numbers = [n for part in pool.map(append, workspaces) for n in part]
    assert sorted(numbers) == list(range(8))
    assert [r["seq"] for r in workspaces[0].events().orderBy("seq").collect()] == list(range(8))


def test_stale_claim_timer(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def land(unit, seq):
        row = [(unit, seq, "claim", "c")]
        spark.createDataFrame(row, "unit_id STRING, seq BIGINT, kind STRING, claim_id STRING").select(
            "*", F.current_timestamp().alias("ts"), F.lit("f").alias("fingerprint")
        ).coalesce(1).write.mode("append").parquet(source)

    land("a", 1)
    schema = "unit_id STRING, seq BIGINT, kind STRING, claim_id STRING, ts TIMESTAMP, fingerprint STRING"
    stream = fold_event_stream(spark.readStream.schema(schema).parquet(source), 1, report_stale=True)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        found = []
        for seq in range(2, 40):
            time.sleep(1)
            land("b", seq)
            if os.path.isdir(f"{out}/_spark_metadata"):
                found = spark.read.schema(FOLD_COLUMNS).parquet(out).filter("kind = 'stale' AND unit_id = 'a'").collect()
            if found:
                break
        assert found and found[0]["status"] == "downloading"
    finally:
        query.stop()
