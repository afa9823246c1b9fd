"""Language model, classifiers and archives."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runloom.llm.quality_classifier import score_quality
from runloom.llm.recurrent_lm import CLASSES, HIDDEN, GatedNetwork, frequent_words, score_documents, shape_of
from runloom.llm.toxicity import score_toxicity
from runloom.llm.warc import archive_pages, gzip_member, read_records, register, warc_record, write_pages

SMALL, LABELLED = "/root/testdata/sf0.001", "/root/testdata/check_s"


def test_gradient():
    rng = np.random.default_rng(0)
    network = GatedNetwork()
    network.weights[:] = rng.normal(0, 0.3, len(network.weights))
    x, y = rng.integers(0, CLASSES, (6, 5)), rng.integers(0, CLASSES, (6, 5))
    y[5, 4] = -1
    keep = np.ones((6, 5), np.float32)
    keep[3, 2] = 0
    h = rng.normal(0, 0.3, (5, HIDDEN)).astype(np.float32)
    gradient = network.loss_and_gradient(x, y, keep, h)[1]
    for k in np.argsort(-np.abs(gradient))[rng.integers(0, 2000, 150)]:
        value, losses = network.weights[k], []
        for step in (0.01, -0.01):
            network.weights[k] = value + step
            losses.append(network.loss_and_gradient(x, y, keep, h)[0])
        network.weights[k] = value
        assert abs((losses[0] - losses[1]) / 0.02 - gradient[k]) <= 0.03 * abs(gradient[k]) + 1e-3


def test_state_is_carried_through_windows():
    rng = np.random.default_rng(2)
    network = GatedNetwork(rng.normal(0, 0.3, len(GatedNetwork().weights)))
    documents = [rng.integers(0, CLASSES, n) for n in (1, 5, 16, 17, 90, 333)]
    together = network.log_likelihoods(documents)
    for document, found in zip(documents, together):
        h, total = np.zeros((1, HIDDEN), np.float32), 0.0
        for before, now in zip([CLASSES, *document[:-1]], document):
            h = network._step(network.inputs[[before]], h)[0]
            logits = (h @ network.output + network.bias)[0].astype(float)
            total += logits[now] - np.log(np.exp(logits).sum())
        assert abs(total - found) < 1e-3 * len(document)


def test_language_model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r["doc_id"]: [*re.findall(r"[^\x20\x09-\x0D]+", r["text"].translate(lower)), None] for r in docs.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    c = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    n, v = sum(c.values()), len(c)
    model, base = 0.0, 0.0
    for r in score_documents(docs).collect():
        ts = tokens[r["doc_id"]]
        expected = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ts), sum(c[t] > 0 for t in ts), n)
        assert abs(r["base_score"] - expected) < 1e-6 * abs(expected)
        if r["held_out"]:
            model, base = model + r["score"], base + r["base_score"]
    assert model > base


def test_all_training_documents_reach_the_weights(spark):
    from runloom.llm import recurrent_lm as lm

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.pmod(F.xxhash64("text"), F.lit(8)) != 0)
    docs = docs.select("doc_id", "text").orderBy("doc_id").limit(40).coalesce(1)
    vocabulary = spark.sparkContext.broadcast(lm.Vocabulary([("", 40), ("the", 9)]))
    classes = lambda texts: [vocabulary.value.classes(lm.words_of(t))[0] for t in texts]
    expected = GatedNetwork()
    for _ in range(lm.SAMPLE_PASSES):
        expected.train(classes(lm._sample(docs, "doc_id", "text")), lm.FIRST_RATE)
    expected = GatedNetwork(expected.weights)
    expected.train(classes([r["text"] for r in docs.collect()]), lm.TASK_RATE)
    assert np.allclose(lm.train_network(docs, vocabulary, "doc_id", "text"), expected.weights, atol=1e-5)


def test_frequent_words_and_shapes(spark):
    counts = spark.createDataFrame([(f"w{k}", max(1, 1000 // (k + 1))) for k in range(3000)], "word string, c long")
    found = frequent_words(counts, 100)
    assert found[:2] == [("w0", 1000), ("w1", 500)] and len(found) <= 100
    from runloom.llm.recurrent_lm import _shape_column

    words = ["a", "ab", "abc", "straße", "日本", "x" * 50]
    rows = spark.createDataFrame([(w,) for w in words], "word string").select("word", _shape_column().alias("kind")).collect()
    assert all(r["kind"] == shape_of(r["word"].encode()) for r in rows)


@pytest.mark.parametrize("score,label,threshold", [(score_toxicity, "toxic", 0.3), (score_quality, "quality", 0.7)])
def test_held_out_accuracy(spark, score, label, threshold):
    if not os.path.isdir(LABELLED):
        pytest.skip("needs tables with thousands of labelled rows of either class")
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    wanted = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    scored = score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    rows = scored.join(wanted, "doc_id").collect()
    assert rows and all(r["held_out"] and r["predicted"] == int(r["score"] >= threshold) for r in rows)
    right = {y: np.mean([r["predicted"] == y for r in rows if r[label] == y]) for y in (0, 1)}
    assert right[0] > 0.93 and right[1] > 0.93


def test_archive_round_trip(spark, tmp_path):
    large, small = "<p>été</p>" * 200, "short"
    rows = [(1, "http://a/1", large), (2, "http://a/é 2", large), (5, None, large), (3, "http://b", small), (4, "http://b", small), (6, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: r for r in archive_pages(pages).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in found.items()} == {
        1: ("revisit", 5), 2: ("revisit", 5), 5: ("response", None), 3: ("response", None), 4: ("response", None), 6: ("response", None)
    }
    assert found[1]["payload_bytes"] == found[5]["payload_bytes"] == len(large.encode()) and found[6]["payload_bytes"] == 0
    path = str(tmp_path / "w")
    write_pages(pages, path)
    records = spark.read.format("warc").option("payload", "true").load(path)
    read = {r["record_id"]: r for r in records.filter("record_type = 'response'").collect()}
    assert bytes(read["5"]["payload"]).decode() == large and bytes(read["3"]["payload"]).decode() == small
    assert [r["target_uri"] for r in records.filter("record_id = '2'").collect()] == ["http://a/é 2"]
    assert records.filter("record_type = 'warcinfo'").count() >= 1 and records.filter(F.col("target_uri").startswith("http://b")).count() == 2


def test_members_without_lengths_are_read():
    import gzip

    record = warc_record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:9>", "WARC-Payload-Digest": "sha1:x"}, b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")
    data = gzip.compress(record) + gzip_member(record) + gzip.compress(record)
    rows = list(read_records(data, lambda row: True, payload=True, verify=False))
    assert [(r[0], r[5], r[6]) for r in rows] == [("9", 3, b"abc")] * 3
    with pytest.raises(ValueError, match="digest"):
        list(read_records(data, lambda row: True, payload=False, verify=True))


def test_only_committed_files_are_read(spark, tmp_path):
    path = str(tmp_path / "w")
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    write_pages(pages, path)
    (tmp_path / "w" / "part-99999-lost.warc.gz").write_bytes(b"half a file")
    register(spark)
    assert spark.read.format("warc").load(path).filter("record_type = 'response'").count() == 1
