"""Quality as a difference of compressed sizes.

One zstandard dictionary is built from pieces of good, one from pieces of bad labelled
text. A document is cut into pieces, each piece is compressed with either dictionary, and
the difference of the two sums, divided by the document's length, is calibrated to a
probability by a logistic model on labelled documents that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fit_logistic, labelled_sample, probability, remainder

PIECE, DICTIONARY, LEVEL = 1024, 1 << 16, 3
#: Pieces per class from which a dictionary is trained.
MOST_PIECES = 8000
#: Added to a document's length in the normalised difference, so that a few words weigh little.
SMOOTH = 64


def pieces_of(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def build_dictionary(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; where there is too little to train on, the text itself."""
    import zstandard

    pieces = [p for t in texts for p in pieces_of(t)]
    step = max(1, len(pieces) // MOST_PIECES)
    pieces = pieces[::step]
    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, pieces)) // 8)), pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(pieces)[-size:]


@lru_cache(maxsize=4)
def compressors(dictionaries: tuple[bytes, ...], level: int = LEVEL) -> tuple:
    """One compressor per dictionary, without sizes, sums and ids in its frames."""
    import zstandard

    made = []
    for content in dictionaries:
        options = {}
        if content:
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=level)
            options = {"dict_data": known}
        made.append(zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False, write_dict_id=False, **options))
    return tuple(made)


def measures(texts: list[bytes], dictionaries: tuple[bytes, bytes]) -> np.ndarray:
    """Normalised difference (bad minus good) and the logarithm of the length, per text."""
    good, bad = compressors(dictionaries)
    out = np.zeros((len(texts), 2))
    for k, text in enumerate(texts):
        with_good = with_bad = 0
        for piece in pieces_of(text):
            with_good += len(good.compress(piece))
            with_bad += len(bad.compress(piece))
        out[k] = (with_bad - with_good) / (len(text) + SMOOTH), np.log1p(len(text))
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, modulus: int, held: int) -> tuple:
    """Two dictionaries and the calibration, from a bounded sample of labelled rows."""
    texts, y, weights = labelled_sample(docs, labels, label, text, key, modulus, held)
    learn = np.arange(len(y)) % 2 == 0
    dictionaries = tuple(build_dictionary([t for t, c, a in zip(texts, y, learn) if a and c == k]) for k in (1, 0))
    rest = ~learn
    x = measures([t for t, a in zip(texts, rest) if a], dictionaries)
    return dictionaries, fit_logistic(x, y[rest], weights[rest])


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    key: str = "doc_id",
    modulus: int = 4,
    held: int = 2,
    threshold: float = 0.7,
) -> DataFrame:
    """``(key, held_out, score, predicted)``, one row per row of ``docs``.

    A null text counts as empty and is scored like any other (by its length alone).
    Labels that are null or not 0 or 1, and labels of null keys, are ignored; of several
    labels of one key the largest counts. With labels of one class only, every score is
    near that class; without labels every score is a half. A null key is not held out.
    Repeated rows are scored row by row; an empty table gives no rows.
    """
    dictionaries, coefficients = fit_quality(docs, labels, label, text, key, modulus, held)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(2)]
            score = pa.array(probability(measures(texts, dictionaries), coefficients), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], ["key", "held_out", "score"])

    rows = docs.select(F.col(key).alias("key"), (remainder(key, modulus) == held).alias("held_out"), F.col(text).alias("text"))
    scores = rows.mapInArrow(scored, f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, score double")
    return scores.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
