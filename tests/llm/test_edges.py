"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from runloom.llm.decontamination import drop_leaking, find_leaks
from runloom.llm.packing import pack_documents
from runloom.llm.quality_classifier import score_quality
from runloom.llm.quality_rules import judge_quality
from runloom.llm.recurrent_lm import score_documents
from runloom.llm.secret_scan import redact_secrets, scan_secrets
from runloom.llm.simhash_dedup import drop_near_duplicates, simhash_components
from runloom.llm.token_counts import count_tokens
from runloom.llm.toxicity import score_toxicity
from runloom.llm.warc import archive_pages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 977} and. " for k in range(30_000))
PLAIN = (
    "The river runs past the old mill and under three small bridges before it meets the sea. "
    "Each spring the water rises, and people from the village carry stones to the weak places of the bank."
)
NUMBERS = " ".join(["version " + "1." * 100_000 + "0", "0." + "123456789" * 10_000, ",".join("10.0.%d.7" % (k % 256) for k in range(20_000)), "7/" * 50_000])
ROWS = [
    (1, PLAIN, "en", "a", len(PLAIN)),
    (1, PLAIN, "en", "a", len(PLAIN)),
    (2, PLAIN, "en", "a", len(PLAIN)),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4),
    (6, LONG, "en", "c", len(LONG)),
    (None, "a text without an id <|endoftext|> é", None, "d", None),
    (None, None, None, None, None),
    (7, "one", "xx", "d", 3),
    (8, NUMBERS, "en", "d", len(NUMBERS)),
]
CLASHES = ["key", "print", "_row", "_key", "_text", "_source", "value", "word", "row", "windows", "hash", "u", "score", "kept", "features", "label"]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, SCHEMA)
    return made.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (6, 1, 0), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(0, PLAIN[:88]), (0, PLAIN[:88]), (1, None), (2, "too short"), (None, "")], "item_id long, text string")


JSON, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
OPERATORS = {
    "tokens": lambda d, la, b: count_tokens(d, JSON),
    "packing": lambda d, la, b: pack_documents(d, WORDS),
    "leaks": lambda d, la, b: find_leaks(d, b),
    "rules": lambda d, la, b: judge_quality(d, la),
    "simhash": lambda d, la, b: simhash_components(d),
    "model": lambda d, la, b: score_documents(d),
    "toxic": lambda d, la, b: score_toxicity(d, la),
    "quality": lambda d, la, b: score_quality(d, la),
    "secrets": lambda d, la, b: scan_secrets(d),
    "warc": lambda d, la, b: archive_pages(d, key="doc_id", url="source", html="text"),
}
PER_ROW = {"tokens", "rules", "simhash", "model", "toxic", "quality", "warc"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, docs, labels, benchmark):
    rows = OPERATORS[name](docs, labels, benchmark).collect()
    if name in PER_ROW:
        count = lambda ids: sorted(ids, key=lambda i: (i is None, i))
        assert count(r.doc_id for r in rows) == count(r[0] for r in ROWS)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    if name == "tokens":
        assert [by_id[k][0].n_tokens for k in (3, 4)] == [0, 0] and by_id[6][0].over_limit
    if name == "packing":
        assert [r.length for r in by_id[3] + by_id[4] + by_id[5]] == [1, 1, 1]
        assert sum(r.length for r in by_id[6]) == by_id[6][0].doc_tokens
        assert sum(r.length for r in by_id[None]) == sum(r.doc_tokens for r in by_id[None] if r.start == 0)
    if name == "leaks":
        assert {r.doc_id for r in rows} == {1, 2} and {r.kind for r in rows} == {"exact"}
    if name == "rules":
        assert [(by_id[k][0].n_words, by_id[k][0].kept) for k in (3, 4, 5)] == [(0, False)] * 3
    if name == "simhash":
        assert {r.component_id for k in (1, 2) for r in by_id[k]} == {1}
        assert {(r.fingerprint, r.component_id) for k in (3, 4, 5) for r in by_id[k]} == {("0" * 16, 3)}
        assert sorted(r.component_id is None for r in by_id[None]) == [False, True]
    if name == "model":
        assert all(r.score <= 0 and r.n_tokens >= 1 for r in rows) and by_id[3][0].n_tokens == 1
    if name in ("toxic", "quality"):
        assert all(0 <= r.score <= 1 for r in rows) and by_id[3][0].score == by_id[4][0].score
    if name == "warc":
        assert {r.record_type for r in by_id[1]} == {"response"} and by_id[3][0].payload_bytes == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, docs, labels, benchmark):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["toxic", "quality", "rules", "leaks"])
def test_no_labels_or_items(name, docs, labels, benchmark):
    rows = OPERATORS[name](docs, labels.limit(0), benchmark.limit(0)).collect()
    if name in ("toxic", "quality"):
        assert {r.score for r in rows} == {0.5}
    if name == "leaks":
        assert rows == []


def test_stages_keep_rows_and_columns(docs, benchmark, labels):
    unique = drop_near_duplicates(docs)
    assert unique.columns == docs.columns
    ids = [r.doc_id for r in unique.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 not in ids
    clean = drop_leaking(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {3, 4, 5, 6, 7, 8, None} and clean.count() == 8
    kept = judge_quality(docs, labels, keep_columns=True)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2}
    secret = docs.withColumn("text", F.concat_ws(" ", "text", F.lit('token = "97ffa88d7c5f5655e365004e29bd123cdabd722a"')))
    rows = redact_secrets(secret)
    assert rows.columns == docs.columns
    texts = [r.text for r in rows.collect()]
    assert len(texts) == len(ROWS) and all("97ffa88d" not in t and "[SECRET]" in t for t in texts)


def test_pipeline_of_nothing(spark, tmp_path, docs, labels, benchmark):
    for name, df in (("documents", docs.select(*[c.split()[0] for c in SCHEMA.split(", ")]).limit(0)), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
