"""Steps whose memory in one task must not grow with the whole input."""

import random

import pandas as pd
from pyspark.sql import functions as F

from runloom.functions.text import plain_in_jvm, plain_texts, without_markup
from runloom.operators.catalog import RunCatalog
from runloom.operators import state as st
from runloom.plans import metadata_queries as mq
from runloom.plans.registry import Tables
from runloom.plans.work_queries import fold_input

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    """The plan as ``explain`` prints it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_attached_facts_do_not_sort_the_catalog(spark):
    tables = Tables(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = tables.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Run"), F.concat(F.lit("SRX"), "l_orderkey").alias("Experiment")
        )
        attached = mq.bundle_of(tables, with_runs=False).attach_to_runs(RunCatalog(frame)).frame
        joins = [line for line in plan_of(attached).splitlines() if "Join [Run#" in line or "Join [Experiment#" in line]
        assert len(joins) == 2 and all("ShuffledHashJoin" in line for line in joins)
        assert attached.count() == frame.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_spread_by_their_number(spark, monkeypatch):
    tables = Tables(spark, SMALL)
    monkeypatch.setattr(mq, "TASK_LINES", 500)
    lines = mq.spread_lines(tables, "l_linenumber")
    assert lines.rdd.getNumPartitions() == tables.lineitem.count() // 500 > 4
    assert lines.select("l_orderkey", F.spark_partition_id().alias("p")).distinct().count() == lines.select("l_orderkey").distinct().count()
    assert lines.exceptAll(tables.lineitem.select("l_orderkey", "l_linenumber")).isEmpty()


def test_plain_texts_are_made_once(spark):
    tables = Tables(spark, SMALL)
    given = tables.orders.select(F.concat(F.lit("<b>x</b> &amp;lt; &eacute; "), "o_orderkey").alias("raw"))
    cleaned = given.select(without_markup(F.col("raw")).alias("plain"))
    assert "regexp_replace" not in plan_of(cleaned).split("ArrowEvalPython")[0]
    assert cleaned.exceptAll(tables.orders.select(F.concat(F.lit("x < é "), "o_orderkey"))).isEmpty()
    decoded = [("&amp;amp;amp;amp;amp;lt;", "&lt;"), ("a & b", "a & b"), ("a; &lt", "a; <"), ("", ""), (None, None)]
    rows = spark.createDataFrame(decoded, "raw STRING, expected STRING").withColumn("found", without_markup(F.col("raw")))
    assert rows.filter("NOT found <=> expected").isEmpty()


def test_open_angles_that_are_text_stay_in_the_engine(spark):
    draw = random.Random(5)
    pieces = ["<", "<b>", "</b>", "<br/>", "< ", "<3", "a", " ", "\n", "/", "!", "?", ">", "&", "&lt;", "&amp;", "<!--", "-->", "<i x='1'>", "\"", "é"]
    given = ["".join(draw.choices(pieces, k=draw.randint(1, 9))) for _ in range(20_000)] + ["<p>1 < 2</p>"]
    rows = spark.createDataFrame([(v,) for v in given], "raw STRING").select("raw", plain_in_jvm(F.col("raw"), angles=True).alias("jvm")).collect()
    expected = plain_texts(pd.Series([r["raw"] for r in rows], dtype=object)).tolist()
    assert [(r["raw"], r["jvm"], e) for r, e in zip(rows, expected) if r["jvm"] is not None and r["jvm"] != e] == []
    assert rows[-1]["jvm"] == "1 < 2"


def test_final_states_come_without_the_rows_between(spark):
    events = fold_input(Tables(spark, SMALL))
    last = st.fold_events(events, stale_seconds=7_200, last_only=True)
    every = st.fold_events(events, stale_seconds=7_200).filter("is_last")
    rows = last.collect()
    assert len(rows) == events.select("unit_id").distinct().count() < events.count()
    assert sorted(map(str, rows)) == sorted(map(str, every.collect()))
