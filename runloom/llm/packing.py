"""Order-preserving packing of documents into token windows by dynamic programming.

The documents of a task, in their order, are one stream of token ids. The stream is cut
at ends of documents and sentences (inside a sentence only where it is very long). Over
the possible cuts ``p_0 < p_1 < ...`` the cheapest way to end a window at ``p_j`` is

    f(j) = min over i of f(i) + padding(p_j - p_i) + penalty(j) + WINDOW_COST

with ``p_j - p_i <= size``. Padding up to ``size`` is ``size - (p_j - p_i)``, so the best
``i`` has the least ``f(i) + p_i`` in a sliding range: a monotone queue gives it in
constant time. A window whose length is a power of two needs no padding; those few
transitions are looked up by position.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_counts import byte_letters

#: Costs in tokens of padding: a cut between sentences, one inside a long sentence, and
#: the opening of a window (so that a tail is not crumbled into tiny powers of two).
SENTENCE_CUT, INNER_CUT, WINDOW_COST = 8, 48, 16
#: A sentence of more tokens than this may be cut at every ``INNER_STEP`` tokens.
LONG_SENTENCE, INNER_STEP = 256, 64
#: Tokens that are planned together; the last windows go on with the next block.
BLOCK_TOKENS = 1 << 18
#: Most words a worker remembers.
MEMO_LIMIT = 400_000
#: Sequence ids: the task's number, then this many bits for the window in the task.
SEQUENCE_BITS = 40
SENTENCE_ENDS = (b".", b"!", b"?", b":", b";", "…".encode(), "。".encode(), "！".encode(), "？".encode())
#: Words of these characters are split here; all others by the library.
PLAIN_WORD = re.compile(r"[!-~¡-įı-ž]+")
#: Fixed value: the pattern that splits words in the tokenizer's file.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Token ids of white-space separated words, as little-endian unsigned 32-bit bytes.

    White space never reaches a token of this vocabulary, so a text's ids are those of its
    words one after the other.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pattern = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if pattern != WORD_PARTS:
            raise ValueError("the vocabulary splits words in another way")
        self.parts = regex.compile(pattern).findall
        self.letters = byte_letters()
        self.part_ids: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _part(self, part: str) -> bytes:
        known = self.part_ids.get(part)
        if known is None:
            if len(self.part_ids) >= MEMO_LIMIT:
                self.part_ids.clear()
            string = part.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tokenizer.model.tokenize(string)]
            known = self.part_ids[part] = pack(f"<{len(ids)}I", *ids)
        return known

    def word(self, raw: bytes) -> bytes:
        known = self.words.get(raw)
        if known is None:
            if len(self.words) >= MEMO_LIMIT:
                self.words.clear()
            word = raw.decode()
            if PLAIN_WORD.fullmatch(word) and "<|" not in word:
                known = b"".join(map(self._part, self.parts(word.lower())))
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                known = pack(f"<{len(ids)}I", *ids)
            self.words[raw] = known
        return known

    def document(self, text: str | None, end_id: int) -> tuple[bytes, np.ndarray]:
        """Ids of a text with the end id, and the token offsets where sentences end."""
        words = text.encode().split() if text else []
        ids = [self.words.get(w) or self.word(w) for w in words]
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4
        closes = np.fromiter((w.endswith(SENTENCE_ENDS) for w in words), bool, len(words))
        return b"".join(ids) + np.array([end_id], "<u4").tobytes(), ends[closes]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def plan_windows(cuts: np.ndarray, penalties: np.ndarray, size: int, closed: bool) -> list[int]:
    """Indexes of the chosen cuts, from 0 on.

    ``cuts`` are increasing positions beginning at 0, less than ``size`` apart. With
    ``closed`` the last window ends at the last cut; otherwise the plan stops at the
    cheapest cut of the last ``size`` positions, and what follows is planned later.
    """
    n = len(cuts)
    short: list[list[int]] = [[] for _ in range(n)]
    length = 1
    while length <= size:
        wanted = cuts - length
        found = np.searchsorted(cuts, wanted)
        for j in np.flatnonzero((wanted >= 0) & (cuts[np.minimum(found, n - 1)] == wanted)):
            short[j].append(int(found[j]))
        length *= 2
    at, extra = cuts.tolist(), (penalties + WINDOW_COST).tolist()
    best, came = [0.0] * n, [0] * n
    queue: deque[int] = deque([0])
    key = [0.0] * n
    for j in range(1, n):
        while at[j] - at[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        cost = key[i] + size - at[j]
        for k in short[j]:
            if best[k] < cost:
                cost, i = best[k], k
        best[j] = cost + extra[j]
        came[j] = i
        key[j] = best[j] + at[j]
        while queue and key[queue[-1]] >= key[j]:
            queue.pop()
        queue.append(j)
    j = n - 1
    if not closed:
        late = np.flatnonzero(cuts > cuts[-1] - size)
        late = late[late > 0]
        j = int(late[np.argmin(np.array(best)[late])])
    chosen = [j]
    while j:
        j = came[j]
        chosen.append(j)
    return chosen[::-1]


def _with_inner(cuts: np.ndarray, penalties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add cuts inside long sentences."""
    gaps = np.diff(cuts)
    added = [np.arange(cuts[k] + INNER_STEP, cuts[k + 1], INNER_STEP) for k in np.flatnonzero(gaps > LONG_SENTENCE)]
    if not added:
        return cuts, penalties
    more = np.concatenate(added)
    every = np.concatenate([cuts, more])
    order = np.argsort(every, kind="stable")
    cost = np.concatenate([penalties, np.full(len(more), INNER_CUT)])
    return every[order], cost[order]


class Packer:
    """Packs one stream of documents; ``add`` and ``finish`` give pieces as they are settled."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        self.docs: list[tuple] = []  # (key, ids, sentence ends, first id that is still open)
        self.open_tokens = 0

    def add(self, key, ids: bytes, ends: np.ndarray) -> list[tuple]:
        self.docs.append((key, ids, ends, 0))
        self.open_tokens += len(ids) // 4
        return self._settle(closed=False) if self.open_tokens >= BLOCK_TOKENS else []

    def finish(self) -> list[tuple]:
        return self._settle(closed=True) if self.docs else []

    def _settle(self, closed: bool) -> list[tuple]:
        starts, total, places, costs = [], 0, [np.zeros(1, np.int64)], [np.zeros(1)]
        for _, ids, ends, first in self.docs:
            starts.append(total)
            left = len(ids) // 4 - first
            inner = ends[(ends > first) & (ends < first + left)] - first
            places.append(np.append(inner, left) + total)
            costs.append(np.append(np.full(len(inner), SENTENCE_CUT), 0))
            total += left
        cuts, first_at = np.unique(np.concatenate(places), return_index=True)
        cuts, costs_at = _with_inner(cuts, np.concatenate(costs)[first_at])
        edges = cuts[plan_windows(cuts, costs_at, self.size, closed)].tolist()
        pieces, k = [], 0
        for low, high in zip(edges, edges[1:]):
            at = low
            while at < high:
                key, ids, _, first = self.docs[k]
                left = len(ids) // 4 - first
                begin = first + at - starts[k]
                until = min(high, starts[k] + left)
                part = ids[4 * begin : 4 * (begin + until - at)]
                pieces.append((key, begin, until - at, zlib.crc32(part), len(ids) // 4, self.sequence, at - low, high - low, part))
                at = until
                if until == starts[k] + left:
                    k += 1
            self.sequence += 1
        self.docs = self.docs[k:]
        if self.docs:
            key, ids, ends, first = self.docs[0]
            self.docs[0] = (key, ids, ends, first + max(0, edges[-1] - starts[k]))
        self.open_tokens = total - edges[-1]
        return pieces


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    size: int = 4096,
    end_id: int = 2,
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a window of at most ``size`` tokens.

    A null or empty text is the end id alone. Documents keep the order in which each task
    reads them; ties, repeated rows and null keys are packed row by row. A document longer
    than a window continues in the next. An empty table gives no rows. Only the two named
    columns are read. ``window_length`` is the number of tokens of the piece's window,
    ``padded_length`` what it takes with padding; ``with_ids`` adds the ids themselves.
    """
    key_type = docs.schema[key].dataType
    arrow_key = docs.select(F.col(key).alias("k")).limit(0).toArrow().schema.field(0).type
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window_length"]
    schema = f"key {key_type.simpleString()}, " + ", ".join(f"{c} long" for c in longs)
    schema += ", ids array<long>" if with_ids else ""

    def table(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces))
        arrays = [pa.array(columns[0], arrow_key), *[pa.array(c, pa.int64()) for c in columns[1:8]]]
        names = ["key", *longs]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in columns[8]], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(tokenizer)
        packer = Packer(size, TaskContext.get().partitionId() << SEQUENCE_BITS)
        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                pieces = packer.add(k.as_py(), *ids.document(t.as_py(), end_id))
                if pieces:
                    yield table(pieces)
        pieces = packer.finish()
        if pieces:
            yield table(pieces)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(packed, schema)
    length = F.col("window_length")
    power = length.bitwiseAND(length - 1) == 0
    out = [F.col("key").alias(key), *longs, F.when(power, length).otherwise(F.lit(size).cast("long")).alias("padded_length")]
    return rows.select(*out, *(["ids"] if with_ids else []))
