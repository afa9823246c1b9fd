import importlib
import linecache
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from runloom.functions import names, values
from runloom.operators import genomes as gn
from runloom.operators import manifest as mf
from runloom.operators import process as pr
from runloom.operators import reads as rd
from runloom.operators import requests as rq
from runloom.operators import state as st
from runloom.ordering import ORD, global_ordinal, with_order
from runloom.streaming.unit_states import fold_event_stream

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def candidate(accession, **changes):
    base = {
        "requested_taxid": 9606, "accession": accession, "taxid": 9606, "scientific_name": "Homo sapiens", "source_database": "GENBANK",
        "assembly_status": "current", "refseq_category": None, "assembly_level": "Chromosome", "release_date": "2020", "contig_n50": 10,
        "scaffold_n50": 0, "total_length": 100, "atypical": False, "warnings": [],
    }
    return base | changes


CANDIDATE = (
    "requested_taxid BIGINT, accession STRING, taxid BIGINT, scientific_name STRING, source_database STRING, assembly_status STRING, refseq_category STRING,"
    " assembly_level STRING, release_date STRING, contig_n50 BIGINT, scaffold_n50 BIGINT, total_length BIGINT, atypical BOOLEAN, warnings ARRAY<STRING>"
)


def choose(spark, rows, pin=None, policy=None):
    table = spark.createDataFrame(rows, CANDIDATE)
    requests = spark.createDataFrame([(9606, pin)], "requested_taxid BIGINT, pin STRING")
    chosen, problems = gn.select_genomes(table, requests, policy)
    return [r["accession"] for r in chosen.collect()], [r["detail"] for r in problems.collect()]


def test_genome_choice(spark):
    rows = [candidate("big", scaffold_n50=10**9), candidate("ref", source_database="REFSEQ", refseq_category="reference genome")]
    assert choose(spark, rows) == (["ref"], [])
    assert choose(spark, rows, policy=gn.GenomeSelectionPolicy(prefer_reference=False, prefer_refseq=False)) == (["big"], [])
    bad = [candidate("w", taxid=1), candidate("s", assembly_status="Suppressed"), candidate("a", atypical=True)]
    assert choose(spark, bad) == ([], ["no assembly satisfies the policy"])
    assert choose(spark, bad, pin="a") == (["a"], [])
    assert choose(spark, bad, pin="none")[1] == ["pinned genome none was not reported"]
    assert choose(spark, bad, pin="w")[1] == ["pinned genome w belongs to taxid 1"]
    assert choose(spark, [candidate("x", assembly_level="Contig")], policy=gn.GenomeSelectionPolicy(minimum_assembly_level="scaffold"))[0] == []
    with pytest.raises(ValueError):
        gn.GenomeSelectionPolicy(minimum_assembly_level="tiny")


def test_custom_genome(spark):
    files = spark.createDataFrame([("/g.fa", 4, "abc", 9)], f"path STRING, size BIGINT, sha256 STRING, {ORD} BIGINT")
    custom = gn.custom_genome(files, taxid=1, scientific_name="X", accession="mine")
    locked = custom.withColumn("accession", F.lit("old")).withColumn(ORD, F.lit(1).cast("bigint"))
    row = gn.upsert_genomes(locked, custom).first()
    assert row["accession"] == "mine" and row[ORD] == 1 and row["selection_rationale"] == ["user-supplied genome"]


def url(name):
    return f"https://x/y/{name}.fastq.gz"


def test_pairing(spark):
    rows = [("u", url(n)) for n in ("sampleB_R2", "sampleA_R1", "orphans", "sampleB_R1", "sampleA_R2")] + [("v", url("sample_R1")), ("u", "https://x/readme.txt")]
    files = rd.classify_read_files(spark.createDataFrame(rows, "unit_id STRING, url STRING"))
    lists = {(r["unit_id"], r["role"]): [f[:8] for f in r["files"]] for r in rd.ordered_file_lists(files).collect()}
    assert lists["u", "read1"] == lists["u", "read2"] == ["sampleA_", "sampleB_"] and lists["u", "single"] == ["orphans."]
    assert {r["unit_id"]: r["layout"] for r in rd.unit_layouts(files).collect()} == {"u": "mixed", "v": "paired"}
    assert [r["key"] for r in rd.pairing_violations(rd.pair_mates(files)).collect()] == ["v"]


def test_layouts_and_merge_order(spark):
    rows = [("u", "SRR2", 0, "read1", "b1"), ("u", "SRR2", 0, "read2", "b2"), ("u", "SRR1", 1, "read1", "a1"), ("u", "SRR1", 1, "read2", "a2"), ("u", "SRR1", 1, "single", "a0")]
    files = spark.createDataFrame(rows, "unit_id STRING, run STRING, run_pos INT, role STRING, path STRING")
    assert rd.unit_layouts_from_runs(files).first()["layout"] == "mixed"
    assert {r["role"]: r["paths"] for r in rd.merge_order(files).collect()} == {"read1": ["b1", "a1"], "read2": ["b2", "a2"], "single": ["a0"]}


@pytest.mark.parametrize("text, expected", [("100G", 100.0), ("1.5 tb", 1500.0), ("500M", 0.5), ("u", None), ("Unlimited", None), ("2000000000", 2.0), ("5kb", 5e-6)])
def test_size_setting(text, expected):
    assert values.size_limit_gb(text) == pytest.approx(expected) if expected is not None else values.size_limit_gb(text) is None


def test_size_setting_errors_and_violation(spark):
    for wrong in ("", "G", "1.2.3G", "-1G", "1.", ".5G"):
        with pytest.raises(ValueError):
            values.size_limit_gb(wrong)
    sizes = spark.createDataFrame([("u", "SRR1", 140.4), ("u", "SRR2", 1.0)], "unit_id STRING, run STRING, size_gb DOUBLE")
    assert [r["detail"] for r in rd.oversized_runs(sizes, "100G").collect()] == ["SRR1=140.400 GB"]
    assert rd.oversized_runs(sizes, "u").count() == 0


QC = "paired_before_reads DOUBLE, paired_after_reads DOUBLE, paired_read1_mean_length DOUBLE, paired_read2_mean_length DOUBLE, single_before_reads DOUBLE, single_after_reads DOUBLE, single_read1_mean_length DOUBLE"


def test_mixed_layout(spark):
    def judge(row, rules=None):
        return rd.mixed_layout_decision(spark.createDataFrame([row], QC), rules).first()

    bad = judge((682111344.0, 406606240.0, 99.0, 99.0, 341055672.0, 2829904.0, 16.0))
    assert bad["action"] == "excluded_single_end" and bad["count_relative_difference"] == 0
    assert bad["reasons"] == [
        "single-read count matches paired-fragment count (relative difference 0)", "single-end mean length is only 16 bp",
        "single-end reads are substantially shorter than paired reads (length ratio 0.162)",
        "fastp retained an unusually small single-end fraction (0.830%)",
    ]
    good = judge((2000.0, 1800.0, 75.0, 75.0, 100.0, 90.0, 70.0))
    assert (good["action"], good["reasons"], good["paired_fragments"], good["count_relative_difference"]) == ("kept_single_end", [], 1000.0, 0.9)
    assert good["single_to_paired_length_ratio"] == pytest.approx(70 / 75) and good["single_retained_fraction"] == 0.9
    empty = judge((None,) * 7)
    assert empty["action"] == "excluded_single_end" and "unavailable" in empty["reasons"][0]
    assert judge((None,) * 7, rd.MixedLayoutRules(enabled=False))["action"] == "disabled"


@pytest.mark.parametrize("number", [0.0, 0.5, 1e-5, 0.0001234567, 16.0, 29.999999, 123456.7, 1234567.0, 0.00099999])
def test_general_number(spark, number):
    assert spark.range(1).select(rd.general_number(F.lit(number))).first()[0] == f"{number:.6g}"


def event(seq, kind, claim=None, fingerprint="f", payload=None, at=None, **flags):
    return {
        "unit_id": "u", "seq": seq, "ts": (T0 + timedelta(seconds=seq if at is None else at)), "kind": kind, "claim_id": claim,
        "fingerprint": fingerprint, "execution_id": "e", "payload": payload, "force": flags.get("force", False),
        "retry_failed": flags.get("retry_failed", False), "reclaim": flags.get("reclaim", False),
    }


STORY = [
    event(1, "claim", "a"), event(2, "claim", "b"), event(3, "phase", "a", payload="processing"), event(4, "genome", "a", payload="g"),
    event(5, "succeed", "a", payload="r"), event(6, "claim", "c"), event(7, "claim", "d", force=True), event(8, "succeed", "a", payload="late"),
    event(9, "ready", "d", payload="p"), event(10, "requeue", payload="lost"), event(11, "phase", "d", payload="processing"), event(12, "claim", "e", fingerprint="g"),
    event(13, "fail", "e", payload="x" * 30_000), event(14, "claim", "h", fingerprint="g"), event(15, "claim", "i", fingerprint="g", retry_failed=True),
    event(16, "claim", "j", fingerprint="g", at=16 + 8 * 86400), event(17, "bogus", "j"),
]


def test_state_fold(spark):
    folded = st.fold_events(spark.createDataFrame(STORY, st.EVENT_COLUMNS))
    rows = {r["seq"]: r for r in folded.collect()}
    assert {s for s, r in rows.items() if r["accepted"]} == {1, 3, 4, 5, 7, 9, 10, 12, 13, 15, 16}
    assert rows[2]["reason"] == "already running" and rows[6]["reason"] == "reusable success" and rows[8]["reason"] == "claim was replaced"
    assert rows[14]["reason"].startswith("failed before")
    assert (rows[3]["status"], rows[4]["genome"], rows[5]["status"], rows[9]["prepared"]) == ("running", "g", "succeeded", "p")
    assert (rows[10]["status"], rows[10]["phase"], rows[10]["claim_id"]) == ("pending", "interrupted", None)
    assert rows[7]["archived_status"] == "succeeded" and rows[7]["attempts"] == 2 and rows[12]["attempts"] == 1
    assert len(rows[13]["error"]) == 20_000 and rows[15]["attempts"] == 2 and rows[16]["attempts"] == 3
    final = st.final_states(folded).first()
    assert (final["status"], final["claim_id"], final["interruption_reason"]) == ("downloading", "j", "lost")
    assert st.archived_states(folded).count() == 2 and st.rejected_events(folded).count() == 6


def test_state_fold_over_many_units_equals_plain_loop(spark):
    from runloom.plans.registry import Tables
    from runloom.plans.work_queries import fold_input

    # A third of all events belong to one unit.
    unit = F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("unit_id"))
    events = st.with_event_defaults(fold_input(Tables(spark, "/root/testdata/sf0.001"))).withColumn("unit_id", unit)
    found = {(r["unit_id"], r["seq"]): r for r in st.fold_events(events, 7_200).collect()}
    assert len(found) == events.count()
    states, last = {}, {}
    for row in sorted(events.collect(), key=lambda r: r["seq"]):
        entry = row.asDict() | {"ts": row["ts"].replace(tzinfo=timezone.utc)}
        state, verdict = st.advance(states.get(row["unit_id"], {}), entry, 7_200)
        states[row["unit_id"]] = state
        last[row["unit_id"]] = row["seq"]
        mine = found[row["unit_id"], row["seq"]]
        assert (mine["accepted"], mine["reason"], mine["archived_status"]) == (verdict["accepted"], verdict.get("reason"), verdict.get("archived_status"))
        for name in ("status", "phase", "attempts", "claim_id", "fingerprint", "interruption_reason"):
            assert mine[name] == state.get(name), (name, row)
    assert {(u, s) for (u, s), r in found.items() if r["is_last"]} == set(last.items())
    assert len({r["reason"] for r in found.values()}) > 3


def test_state_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = spark.createDataFrame(STORY, st.EVENT_COLUMNS)
    for low, high in ((0, 6), (6, 11), (11, 99)):
        events.filter((F.col("seq") > low) & (F.col("seq") <= high)).coalesce(1).write.mode("append").parquet(source)
        stream = fold_event_stream(spark.readStream.schema(st.EVENT_COLUMNS).parquet(source))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    columns = ["seq", "accepted", "reason", "status", "phase", "attempts", "claim_id", "started_at", "archived_status"]
    batch = st.fold_events(events).select(*columns).orderBy("seq").collect()
    assert spark.read.parquet(out).select(*columns).orderBy("seq").collect() == batch


def test_stream_puts_unordered_events_in_order(spark, tmp_path):
    """More events than are held, in one micro-batch, last first and with gaps over several buckets."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    story = [e | {"seq": e["seq"] * 400} for e in STORY]
    events = spark.createDataFrame(story, st.EVENT_COLUMNS)
    events.orderBy(F.desc("seq")).coalesce(1).write.parquet(source)
    stream = fold_event_stream(spark.readStream.schema(st.EVENT_COLUMNS).parquet(source), held_events=3)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    columns = ["seq", "accepted", "reason", "status", "phase", "attempts", "claim_id", "is_last"]
    batch = st.fold_events(events).select(*columns).orderBy("seq").collect()
    assert spark.read.parquet(out).select(*columns).orderBy("seq").collect() == batch and len(batch) == len(STORY)


@pytest.mark.parametrize("cut", [1, 6, 9, 13])
def test_fold_from_a_snapshot_equals_the_whole(spark, tmp_path, cut):
    events = spark.createDataFrame(STORY, st.EVENT_COLUMNS)
    before, after = events.filter(F.col("seq") <= cut), events.filter(F.col("seq") > cut)
    snapshot = st.final_states(st.fold_events(before))
    columns = ["seq", "accepted", "reason", "status", "phase", "attempts", "claim_id", "started_at", "genome", "result", "error", "archived_status"]
    whole = st.fold_events(events).filter(F.col("seq") > cut).select(*columns).orderBy("seq").collect()
    assert st.fold_events(after, snapshot=snapshot).select(*columns).orderBy("seq").collect() == whole
    if cut == 9:
        after.coalesce(1).write.parquet(str(tmp_path / "in"))
        stream = fold_event_stream(spark.readStream.schema(st.EVENT_COLUMNS).parquet(str(tmp_path / "in")), snapshot=snapshot)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).select(*columns).orderBy("seq").collect() == whole


def test_summary_with_unknown_unit(spark):
    states = spark.createDataFrame([("a", "submitted")], "unit_id STRING, status STRING")
    asked = spark.createDataFrame([("a",), ("b",)], "unit_id STRING")
    counts = {r["status"]: r["n"] for r in st.status_counts(states, asked).collect()}
    assert counts["submitted"] == 1 and counts["pending"] == 1 and counts["failed"] == 0 and len(counts) == 7


def test_resume_after_force_and_reclaim(spark):
    items = spark.createDataFrame([("ok", "f"), ("broken", "f"), ("failed", "f"), ("busy", "f"), ("old", "f"), ("new", "f"), ("changed", "g")], "unit_id STRING, fingerprint STRING")
    old = T0 - timedelta(days=30)
    states = spark.createDataFrame(
        [("ok", "succeeded", "completed", "f", 1, old), ("broken", "succeeded", "completed", "f", 1, old), ("failed", "failed", "failed", "f", 2, old),
         ("busy", "running", "processing", "f", 1, T0), ("old", "running", "processing", "f", 1, old), ("changed", "succeeded", "completed", "f", 4, old)],
        "unit_id STRING, status STRING, phase STRING, fingerprint STRING, attempts INT, started_at TIMESTAMP",
    )
    valid = spark.createDataFrame([("ok", True), ("broken", False), ("changed", True)], "unit_id STRING, valid BOOLEAN")

    def plan(**options):
        rows = st.plan_resume(items, states, valid, F.lit(T0), **options).collect()
        return {r["unit_id"]: (r["action"], r["attempts"], r["reset_outputs"], r["archive_previous"]) for r in rows}

    first = plan()
    assert first == {
        "ok": ("reuse", None, False, False), "broken": ("claim", 2, True, True), "failed": ("skip_failed", None, True, False),
        "busy": ("already_running", None, True, False), "old": ("claim", 2, True, False), "new": ("claim", 1, True, False), "changed": ("claim", 1, True, True),
    }
    assert plan(retry_failed=True)["failed"][:2] == ("claim", 3) and plan(reclaim_running=True)["busy"][:2] == ("claim", 2)


def test_processor(spark, tmp_path):
    def demo(fastq, genome, context):
        if fastq["bad"]:
            raise RuntimeError("boom")
        if genome["accession"] == "none":
            return "wrong type"
        return pr.ProcessingResult(True, {"coverage": context["path"]}, {"n": 1})

    (tmp_path / "x.bw").write_text("1")
    rows = [("a", (False,), ("g",), (str(tmp_path), "x.bw")), ("b", (True,), ("g",), (str(tmp_path), "x.bw")), ("c", (False,), ("g",), (str(tmp_path), "../x.bw")),
            ("d", (False,), ("g",), (str(tmp_path), "lost.bw")), ("e", (False,), ("none",), (str(tmp_path), "x.bw"))]
    units = spark.createDataFrame(rows, "unit_id STRING, fastq STRUCT<bad: BOOLEAN>, genome STRUCT<accession: STRING>, context STRUCT<output_dir: STRING, path: STRING>")
    done = {r["unit_id"]: r for r in pr.run_units(units, demo).collect()}
    assert [done[u]["status"] for u in "abcde"] == ["succeeded", "failed", "failed", "failed", "failed"]
    assert done["a"]["outputs"] == {"coverage": str(tmp_path / "x.bw")} and "boom" in done["b"]["error"] and "outside" in done["c"]["error"]
    assert pr.load_processor("json:dumps") and pr.processor_identity("m:f") == "m:f" and pr.processor_identity(demo, "v1") == "v1"
    with pytest.raises(ValueError):
        pr.load_processor("json")
    described = pr.with_descriptions(
        units.withColumn("experiment_accessions", F.array("unit_id")), spark.createDataFrame([("a", "{}")], "experiment STRING, description STRING")
    )
    assert described.filter("unit_id = 'a'").first()["context"]["description"] == "{}"


def test_changed_code_is_another_processor(tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    code = tmp_path / "made_processor.py"

    def identity(text, build=lambda m: m.work):
        code.write_text(text)
        sys.modules.pop("made_processor", None)
        importlib.invalidate_caches()
        linecache.clearcache()
        return pr.processor_identity(build(importlib.import_module("made_processor")))

    plain = "def work(fastq, genome, context):\n    return 1\n"
    first = identity(plain)
    assert first == identity(plain) and first.startswith("work@")
    assert identity(plain.replace("1", "2")) != first
    kind = "class Work:\n    def __init__(self, config):\n        self.config = config\n    def __call__(self, *parts):\n        return None\n"
    made = [identity(kind, lambda m, c=c: m.Work(c)) for c in ({"a": 1}, {"a": 1}, {"a": 2})]
    assert made[0] == made[1] != made[2] and made[0].startswith("Work@")
    assert pr.processor_identity(len).startswith("len@") and pr.processor_identity(len) != pr.processor_identity(max)


def test_requests(spark):
    ids = spark.createDataFrame([(" A1 ", 3), ("A1", 1), ("77", 0), ("", 5), ("B2", 2), ("C3", 4)], f"id STRING, {ORD} BIGINT")
    plan = rq.request_ids(ids)
    rows = rq.resolve_requests(plan, size=2).orderBy("chunk").collect()
    assert [r["request"] for r in rows] == ['"A1"[Accession] OR "B2"[Accession]', '"C3"[Accession]']
    assert rq.chunked(plan, 100).first()["request"] == "77,A1,B2,C3"
    with pytest.raises(ValueError):
        rq.chunked(plan, 0)
    with pytest.raises(ValueError):
        rq.resolve_requests(plan, field="a]b")


def test_ordinals_and_digest_tree(spark):
    import hashlib

    rows = with_order(spark.range(1000).repartition(7).select((999 - F.col("id")).alias("n")), "n")
    numbered = global_ordinal(rows, ["n"])
    assert numbered.filter("ordinal <> n").count() == 0 and numbered.count() == 1000
    items = spark.range(25).select(F.col("id").cast("string").alias("fingerprint"), "id")
    texts = [str(i) for i in range(25)]
    sha = lambda parts: hashlib.sha256("\n".join(parts).encode()).hexdigest()
    assert mf.items_digest(items, ["id"]).first()["digest"] == sha(texts)
    pieces = [sha(texts[i:i + 10]) for i in range(0, 25, 10)]
    assert tuple(mf.items_digest(items, ["id"], chunk=10).first()) == (sha(pieces), 25)


def test_digest_of_many_items_is_that_of_their_joined_text(spark):
    import hashlib

    n = 10_250
    items = spark.range(n).repartition(7).select(F.sha2(F.col("id").cast("string"), 256).alias("fingerprint"), F.lpad("id", 6, "0").alias("unit_id"))
    texts = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    assert tuple(mf.items_digest(items, ["unit_id"]).first()) == (hashlib.sha256("\n".join(texts).encode()).hexdigest(), n)


def test_names(spark):
    rows = spark.createDataFrame([("https://h/a%20b/x_R1.fastq.gz?q=1#f", "x_R1.fastq.gz"), ("https://h", ""), ("ftp://h/dir/", "dir"), ("https://h/a/b%2Bc+d;p=1", "b+c+d")], "url STRING, expected STRING")
    assert rows.filter(names.url_file_name(F.col("url")) != F.col("expected")).count() == 0
    series = spark.createDataFrame([("GSE123456", "GSE123nnn"), ("gse12", "GSEnnn"), ("GSM1", None)], "a STRING, b STRING")
    assert series.filter(~names.series_bucket(F.col("a")).eqNullSafe(F.col("b"))).count() == 0


def test_chunks_of_a_hot_unit_follow_each_other(spark):
    rows = [("u", role, pos, f"{role}_{pos:03d}") for role in ("read1", "read2") for pos in range(25)] + [("v", "single", 0, "x")]
    files = spark.createDataFrame(rows, "unit_id STRING, role STRING, run_pos INT, path STRING").repartition(5)
    found = {}
    for r in sorted(rd.merge_order(files, limit=4).collect(), key=lambda r: r["chunk"]):
        found.setdefault((r["unit_id"], r["role"]), []).append(list(r["paths"]))
    assert [len(c) for c in found["u", "read1"]] == [4] * 6 + [1]
    for first, second in zip(found["u", "read1"], found["u", "read2"]):
        assert [p[5:] for p in first] == [p[5:] for p in second]
    assert sum(found["u", "read1"], []) == [f"read1_{k:03d}" for k in range(25)] and found["v", "single"] == [["x"]]
