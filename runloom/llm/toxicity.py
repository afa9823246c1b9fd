"""Toxicity by compression distance.

Ordinary and toxic text each give a zstandard dictionary. The toxic one holds, after all
of the ordinary one, the words of toxic documents with letter sequences that are several
times as frequent there; so a window compresses better with it exactly where it repeats
what only toxic text has. A window is one word. Short inputs hardly compress, so a window
is the word several times over: only its first copy costs more than a few bytes, and the
difference of the two lengths is what the dictionary saves on the word. A document's
measures are the numbers of its windows by difference; a logistic model on labelled
documents that the dictionaries have not seen calibrates them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fit_logistic, labelled_sample, probability, remainder
from .support import LETTERS_LOWER, LETTERS_UPPER

GRAM, LEAST_DOCS, LEAST_RATIO = 5, 4, 8.0
#: Words of either dictionary, level of compression, copies of the word in a window.
ORDINARY_WORDS, TOXIC_WORDS, LEVEL, COPIES = 16000, 1500, 12, 5
#: Differences (bytes) from which windows are counted: those of at least 2, 3, ... 8.
STEPS = tuple(range(2, 9))
#: Words that a worker remembers, and the longest that is compressed as one window.
MEMO_LIMIT, LONGEST = 300_000, 64
_LOWER = bytes.maketrans(LETTERS_UPPER.encode(), LETTERS_LOWER.encode())
_MARKS = b".,!?;:'\"()[]{}<>#$%&*|-_/\\=+~`@^"


def windows_of(text: bytes) -> list[bytes]:
    """The words in lower case without marks around them; long ones in parts."""
    words = [w.strip(_MARKS) for w in text.translate(_LOWER).split()]
    if max(map(len, words), default=0) > LONGEST:
        words = [w[i : i + LONGEST] for w in words for i in range(0, max(1, len(w)), LONGEST)]
    return words


def _grams(word: bytes) -> set[bytes]:
    return {word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1))} if len(word) >= GRAM - 1 else set()


def build_dictionaries(texts: list[bytes], y: np.ndarray) -> tuple[bytes, bytes]:
    """(toxic, ordinary) dictionaries as raw content, the most telling words last."""
    docs = [set(windows_of(t)) for t in texts]
    grams: tuple[Counter, Counter] = (Counter(), Counter())
    for words, c in zip(docs, y):
        grams[c].update(set().union(*map(_grams, words)))
    n = np.bincount(y, minlength=2)
    ordinary_share = lambda g: (grams[0][g] + 0.5) / (n[0] + 1)
    telling = {g for g, k in grams[1].items() if k >= LEAST_DOCS and (k + 0.5) / (n[1] + 1) >= LEAST_RATIO * ordinary_share(g)}
    toxic: Counter = Counter()
    ordinary: Counter = Counter()
    for words, c in zip(docs, y):
        if c:
            toxic.update(w for w in words if not telling.isdisjoint(_grams(w)))
        else:
            ordinary.update(words)
    by_count = lambda counter, most: [w for w, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:most]][::-1]
    common = b" ".join(by_count(ordinary, ORDINARY_WORDS)) + b" "
    return common + b" ".join(by_count(toxic, TOXIC_WORDS)) + b" ", common


@lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[bytes, bytes]) -> tuple:
    import zstandard

    made = []
    for content in dictionaries:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))
    return tuple(made)


class Distances:
    """Differences of the compressed lengths of words, remembered per worker."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.toxic, self.ordinary = (c.compress for c in _compressors(dictionaries))
        self.memo: dict[bytes, int] = {}

    def of(self, word: bytes) -> int:
        known = self.memo.get(word)
        if known is None:
            if len(self.memo) >= MEMO_LIMIT:
                self.memo.clear()
            window = (b" " + word) * COPIES + b" "
            known = self.memo[word] = len(self.ordinary(window)) - len(self.toxic(window))
        return known

    def measures(self, text: bytes) -> list[float]:
        words = windows_of(text)
        known, of = self.memo.get, self.of
        found = Counter(d if (d := known(w)) is not None else of(w) for w in words)
        total = max(1, len(words))
        counts = [sum(n for d, n in found.items() if d >= step) for step in STEPS]
        return [float(np.log1p(total)), *[float(np.log1p(c)) for c in counts], *[float(np.sqrt(c / total)) for c in counts]]


@lru_cache(maxsize=2)
def _distances(dictionaries: tuple[bytes, bytes]) -> Distances:
    return Distances(dictionaries)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, modulus: int, held: int) -> tuple:
    """Dictionaries and calibration from a bounded sample of labelled rows."""
    texts, y, weights = labelled_sample(docs, labels, label, text, key, modulus, held)
    learn = np.arange(len(y)) % 2 == 0
    dictionaries = build_dictionaries([t for t, a in zip(texts, learn) if a], y[learn])
    distances = _distances(dictionaries)
    rest = ~learn
    x = np.array([distances.measures(t) for t, a in zip(texts, rest) if a]).reshape(-1, 1 + 2 * len(STEPS))
    return dictionaries, fit_logistic(x, y[rest], weights[rest])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    text: str = "text",
    key: str = "doc_id",
    modulus: int = 4,
    held: int = 2,
    threshold: float = 0.3,
) -> DataFrame:
    """``(key, held_out, score, predicted)``, one row per row of ``docs``.

    A null text counts as empty: no windows, scored like any other. Labels that are null
    or not 0 or 1, and labels of null keys, are ignored; of several labels of one key the
    largest counts. With labels of one class only, every score is near that class; without
    labels every score is a half. A null key is not held out. Repeated rows are scored row
    by row; an empty table gives no rows.
    """
    dictionaries, coefficients = fit_toxicity(docs, labels, label, text, key, modulus, held)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = _distances(dictionaries).measures
        for batch in batches:
            x = np.array([measures((t.as_py() or "").encode()) for t in batch.column(2)]).reshape(-1, 1 + 2 * len(STEPS))
            score = pa.array(probability(x, coefficients), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], ["key", "held_out", "score"])

    rows = docs.select(F.col(key).alias("key"), (remainder(key, modulus) == held).alias("held_out"), F.col(text).alias("text"))
    scores = rows.mapInArrow(scored, f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, score double")
    return scores.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
