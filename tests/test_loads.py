"""Append-only metadata loads: writers side by side, bytes per batch, what enters, merged deltas."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from runloom.operators.bundle import Bundle
from runloom.ordering import ORD
from runloom.sources import commit_log
from runloom.sources.commit_log import CommitLog
from runloom.sources.schemas import struct_type
from runloom.streaming.metadata_loads import MetadataLoad, named_experiment, named_runs


def collection(spark, name, rows):
    schema = struct_type(name)
    full = [tuple(r.get(f.name) for f in schema) for r in rows]
    return spark.createDataFrame(full, schema).coalesce(1).withColumn(ORD, F.monotonically_increasing_id())


def experiments(spark, numbers, title):
    return Bundle(experiments=collection(spark, "experiments", [{"accession": f"X{n}", "title": f"{title} {n}"} for n in numbers]))


def bytes_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_numbers_are_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda k: log.append({"path": str(k), "collections": [], "sources": {}, "judged": -1}), range(40)))
    assert sorted(taken) == list(range(40)) and log.size() == 40
    assert sorted(int(log.entry(n)["path"]) for n in range(40)) == list(range(40))
    assert log.append({"path": "late"}, lambda other: True) == 40
    assert [(s.first, s.last, s.level) for s in log.segments(3)] == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]
    # A merged table stands for its commits; where one is missing its parts do.
    assert log.files.create("merged/01-000000000008.json", {"path": "m", "collections": []})
    assert not log.files.create("merged/01-000000000008.json", {"path": "other"})
    spans = [(s.first, s.last) for s in log.segments(20)]
    assert spans == [(k, k) for k in range(8)] + [(8, 15)] + [(k, k) for k in range(16, 20)]


def test_two_writers_lose_nothing(spark, tmp_path):
    first, second = (MetadataLoad(spark, str(tmp_path / "store")) for _ in range(2))

    def write(load, source, start):
        for batch in range(3):
            load.apply(experiments(spark, range(start + 10 * batch, start + 10 * batch + 12), source), batch, source)

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(write, first, "left", 0), pool.submit(write, second, "right", 100)]:
            done.result()
    rows = {r["accession"]: r["title"] for r in first.current().experiments.collect()}
    assert set(rows) == {f"X{n}" for start in (0, 100) for n in range(start, start + 32)}
    assert all(first.committed(s, b) for s in ("left", "right") for b in range(3)) and not first.committed("left", 3)
    # The same batch again, as after a lost driver, changes nothing.
    before = first.log.size()
    second.apply(experiments(spark, [0, 999], "again"), 2, "left")
    assert first.log.size() == before and first.current().experiments.filter("accession = 'X999'").isEmpty()


@pytest.mark.parametrize("fan_in", [3])
def test_bytes_of_a_batch_do_not_follow_the_store(spark, tmp_path, monkeypatch, fan_in):
    monkeypatch.setattr(commit_log, "FAN_IN", fan_in)
    load = MetadataLoad(spark, str(tmp_path / "store"))
    sizes = []
    for batch in range(5):
        load.apply(experiments(spark, range(50 * batch, 50 * batch + 60), f"v{batch:02d}"), batch)
        written = [load.log.entry(n) for n in range(load.log.size())]
        sizes.append(bytes_of(next(e["path"] for e in reversed(written) if e["sources"])))
    assert max(sizes) < 1.3 * min(sizes)
    segments = load.log.segments()
    assert max(s.level for s in segments) >= 2 and len(segments) < load.log.size() / 2
    rows = load.current().experiments.orderBy(ORD).collect()
    # Keys stay where they came first and show the batch that wrote them last.
    assert [r["accession"] for r in rows] == [f"X{n}" for n in range(260)]
    assert [r["title"] for r in rows] == [f"v{min(n // 50, 4):02d} {n}" for n in range(260)]


PACKAGE = (
    '<EXPERIMENT_PACKAGE><EXPERIMENT alias="a" accession="{x}"><TITLE>t</TITLE></EXPERIMENT><SAMPLE accession="S{x}"/>'
    "<RUN_SET><RUN alias='b' accession='R{x}'/></RUN_SET></EXPERIMENT_PACKAGE>"
)


def test_only_missing_packages_enter(spark, tmp_path):
    load = MetadataLoad(spark, str(tmp_path / "store"))

    def records(*names):
        rows = [(PACKAGE.format(x=n) if n else "<EXPERIMENT_PACKAGE></EXPERIMENT_PACKAGE>", "f", 0) for n in names]
        return spark.createDataFrame(rows, "xml STRING, file STRING, split BIGINT")

    def chosen(rows, **options):
        return sorted(r["x"] for r in load.wanted_packages(rows, **options).select(named_experiment(F.col("xml")).alias("x")).collect())

    both = records("X1", "X2", "")
    assert both.select(F.explode(named_runs(F.col("xml")))).count() == 2
    assert chosen(both) == ["", "X1", "X2"]
    load.apply_packages(records("X1"), 0)
    assert {r["experiment_accession"]: r["complete"] for r in load.index().collect()} == {"X1": True}
    assert chosen(both) == ["", "X2"] and chosen(both, refresh=True) == ["", "X1", "X2"] and chosen(both, include_raw=True) == ["", "X1", "X2"]
    assert chosen(records("X2", "X3"), scope=spark.createDataFrame([("X3",)], "experiment_accession STRING")) == ["X3"]
    assert chosen(records("X2", "X3"), scope=spark.createDataFrame([("RX2",), (None,)], "Run STRING")) == ["X2"]
    load.apply_packages(records("X1", "X2"), 1)
    parsed = spark.read.parquet(*[e.path for e in os.scandir(tmp_path / "store/parsed") if e.name.endswith("00000001")])
    assert parsed.count() == 1 and load.current().experiments.count() == 2
    # A stale index withdraws completeness; it never hides records that are absent.
    stale = spark.createDataFrame([("X1", "SX1", None, False, False)], "experiment_accession STRING, sra_sample STRING, biosample STRING, complete BOOLEAN, raw_available BOOLEAN")
    load.index = lambda: stale
    assert chosen(records("X1", "X2", "X9")) == ["X1", "X2", "X9"]


def test_index_follows_both_kinds(spark, tmp_path):
    load = MetadataLoad(spark, str(tmp_path / "store"))
    linked = Bundle(
        packages=collection(spark, "packages", [{"accession": "X1", "experiment_accession": "X1", "sra_sample_accession": "S1"}]),
        experiments=collection(spark, "experiments", [{"accession": "X1"}]),
        sra_samples=collection(spark, "sra_samples", [{"accession": "S1", "biosample": "B1"}]),
    )
    load.apply(linked, 0, "packages")
    index = lambda: {r["experiment_accession"]: (r["biosample"], r["complete"]) for r in load.index().collect()}
    assert index() == {"X1": ("B1", False)}
    load.apply(Bundle(biosamples=collection(spark, "biosamples", [{"accession": "B1"}])), 0, "biosamples")
    assert index() == {"X1": ("B1", True)}
    size = load.log.size()
    load.refresh_index()
    assert load.log.size() == size
    empty = MetadataLoad(spark, str(tmp_path / "empty"))
    empty.refresh_index()
    assert empty.index().isEmpty() and empty.current().runs.isEmpty() and empty.log.size() == 0


def test_index_joins_each_link_once(spark):
    """The index agrees with ``complete_experiments`` and does not join the links anew for each verdict."""
    full = Bundle(
        packages=collection(
            spark,
            "packages",
            [{"accession": f"P{n}", "experiment_accession": f"X{n % 7}" if n else "", "sra_sample_accession": ["S0", "S1", "S2", "S9", ""][n % 5]} for n in range(12)],
        ),
        experiments=collection(spark, "experiments", [{"accession": f"X{n}", "raw": "r" if n % 2 else None} for n in (0, 1, 2, 3, 5, 8)]),
        sra_samples=collection(spark, "sra_samples", [{"accession": f"S{n}", "biosample": b, "raw": r} for n, (b, r) in enumerate([("B0", "r"), ("B1", "r"), ("", None)])]),
        biosamples=collection(spark, "biosamples", [{"accession": "B0", "raw": "r"}]),
    )
    index = full.completeness_index()
    rows = {r["experiment_accession"]: r for r in index.collect()}
    for flag, raw in (("complete", False), ("raw_available", True)):
        done = {r[0] for r in full.complete_experiment_accessions(include_raw=raw).collect()}
        assert {x for x, r in rows.items() if r[flag]} == done and done
    assert {x: r["sra_sample"] for x, r in rows.items()} == {"X0": "S2", "X1": "S9", "X2": "S2", "X3": "S0", "X4": "S1", "X5": "S0", "X6": "S1"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = full.completeness_index()._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2


def test_first_load_reads_texts_once(spark, tmp_path):
    """With nothing stored no text is read to find what is complete, and a table without repeats is not merged."""
    load = MetadataLoad(spark, str(tmp_path / "store"))
    records = spark.createDataFrame([(PACKAGE.format(x=n), "f", 0) for n in ("X1", "X1", "X2")], "xml STRING, file STRING, split BIGINT")
    chosen = load.wanted_packages(records)
    assert chosen.count() == 3 and "Join" not in chosen._jdf.queryExecution().optimizedPlan().toString()
    load.apply_packages(records, 0)
    now = load.current()
    assert sorted(r["accession"] for r in now.experiments.collect()) == ["X1", "X2"]
    assert "Aggregate" not in now.experiments._jdf.queryExecution().optimizedPlan().toString()
    repeated = collection(spark, "experiments", [{"accession": "X3", "title": t} for t in ("a", "b")])
    load.apply(Bundle(experiments=repeated), 0, "other")
    assert {r["accession"]: r["title"] for r in load.current().experiments.collect()} == {"X1": "t", "X2": "t", "X3": "b"}
