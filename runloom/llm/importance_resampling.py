"""Importance resampling of documents towards a target corpus by hashed n-grams.

Words are lower-cased (A-Z only) and every run of separators becomes one blank; then a
regular expression with boundary lookarounds, searched with overlaps, emits the spans of
all n-grams of a text, and each span is counted in the bucket of its CRC-32. A bucket's
gain compares its share in the target with its share in the corpus; a document's weight
is the mean gain of its n-grams, and a hashed Gumbel term turns weights into a draw
without replacement.

Texts are scanned once: the buckets of every document and one row of counts per task are
written to the shared folder, and weights are taken from there. Nothing is sampled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordering import global_ordinal
from .support import stored

#: Production parameters: longest n-gram, buckets, words a drawn document must have, the
#: drawn percentage and the seed of the draw.
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Spans whose bucket a task remembers; others are hashed each time.
MEMO_SPANS = 1 << 17
_SCANNED = "_key {key}, _words bigint, _buckets array<int>, _counts array<bigint>"


def _byte(code: int) -> int:
    """A-Z in lower case, letters, digits and non-ASCII bytes as they are, a blank for the rest."""
    if 0x41 <= code <= 0x5A:
        return code + 32
    return code if 0x30 <= code <= 0x39 or 0x61 <= code <= 0x7A or code >= 0x80 else 0x20


FOLDED = bytes(_byte(code) for code in range(256))


def ngram_patterns(longest: int) -> list[regex.Pattern]:
    """One pattern per length; a span starts and ends at a border of words."""
    return [regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1)) for n in range(1, longest + 1)]


def collapsed(text: str | None) -> bytes:
    """The words of a text, lower-cased, with single blanks between them; null gives none."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split())


class _Buckets(dict):
    """Bucket of each span, remembered up to a bound."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, span: bytes) -> int:
        bucket = zlib.crc32(span) % self.buckets
        if len(self) < MEMO_SPANS:
            self[span] = bucket
        return bucket


def bucketed(docs: DataFrame, text: str, key: str, longest: int, buckets: int) -> DataFrame:
    """Per document its number of words and the bucket of each n-gram, and one row of
    bucket counts per task (``_counts`` is null in rows of documents)."""
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    key_type = source.schema["_key"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, bucket_of = ngram_patterns(longest), _Buckets(buckets)
        total = np.zeros(buckets, np.int64)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            found, words = [], []
            for value in batch.column(1):
                line = collapsed(value.as_py())
                spans = (m.group() for p in patterns for m in p.finditer(line, overlapped=True))
                found.append(np.fromiter(map(bucket_of.__getitem__, spans), np.int32))
                words.append(line.count(b" ") + 1 if line else 0)
            ends = np.cumsum([0] + [len(f) for f in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            total += np.bincount(flat, minlength=buckets)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            none = pa.nulls(len(found), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), lists, none], names)
        if kind is not None:
            row = [pa.nulls(1, kind), pa.array([0]), pa.nulls(1, pa.list_(pa.int32())), pa.array([total.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(row, names)

    names = ["_key", "_words", "_buckets", "_counts"]
    return source.mapInArrow(scan, _SCANNED.format(key=key_type))


def bucket_totals(scanned: DataFrame, name: str) -> DataFrame:
    """Features per bucket: the sums of the tasks' counts."""
    rows = scanned.filter(F.col("_counts").isNotNull()).select(F.posexplode("_counts").alias("bucket", "n"))
    return rows.filter("n > 0").groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of every bucket; two counts for each of ``buckets`` rows come to the driver.

    ``floor(1000 * ln((t+1) * (S+buckets) / ((s+1) * (T+buckets))))`` in doubles.
    """
    spark = corpus.sparkSession
    both = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(bucket_totals(corpus, "s"), "bucket", "left")
        .join(bucket_totals(target, "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    sums = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = (F.col("t") + 1) * F.lit(sums["S"] + buckets) / ((F.col("s") + 1) * F.lit(sums["T"] + buckets))
    rows = both.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain")).collect()
    gains = np.zeros(buckets, np.int64)
    for row in rows:
        gains[row["bucket"]] = row["gain"]
    return gains


def weighted(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """``(_key, _words, n_features, weight)``: the floored mean gain of each document."""
    rows = scanned.filter(F.col("_counts").isNull()).drop("_counts")
    key_type = rows.schema["_key"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])])
            ends = ends - ends[0]
            n = ends[1:] - ends[:-1]
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                ["_key", "_words", "n_features", "weight"],
            )

    return rows.mapInArrow(weigh, f"_key {key_type}, _words bigint, n_features bigint, weight bigint")


def gumbel_term(key: Column, seed: int) -> Column:
    """``floor(-1000 * ln(-ln((h+0.5) / 2^32)))`` with 32 bits of a hash of seed and key."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    target_text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the N documents with at least ``least_words`` words the ``floor(percent * N / 100)``
    of highest score are drawn and ranked 1, 2, 3 …, ties to the smaller key; the rank of
    the others is null. Ranks come from a range partitioning, not from one sorted task.

    A null or empty text has no n-grams and weight 0. A null key hashes as the empty text
    and sorts first among ties. Repeated rows are documents of their own and count each;
    their ranks follow each other in any order. Empty tables give no rows, an empty target
    is one with no features. Other columns are not read, whatever their names.
    """
    scanned = stored(bucketed(docs, text, key, longest, buckets), "resampling-buckets")
    aims = bucketed(target.withColumn("_id", F.lit(0)), target_text, "_id", longest, buckets)
    gains = bucket_gains(scanned, aims, buckets)
    score = F.col("weight") + gumbel_term(F.col("_key"), seed)
    rows = stored(weighted(scanned, gains).withColumn("score", score), "resampling-weights")
    able = F.col("_words") >= least_words
    drawn = percent * rows.filter(able).count() // 100
    ranked = global_ordinal(rows.filter(able).withColumn("_lowest", -F.col("score")), ["_lowest", "_key"], "_place")
    place = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long")
    columns = [F.col("_key").alias("doc_id"), "n_features", "weight", "score"]
    return ranked.select(*columns, place.alias("rank")).unionByName(
        rows.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
