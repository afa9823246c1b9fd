"""Near duplicates by SimHash, found through an inverted index of byte positions.

A fingerprint has eight bytes. Two fingerprints that differ in at most four bits differ in
at most four bytes, so they share at least four of eight (position, byte) entries: that is
the count a pair must reach. Single postings would hold 1/256 of all fingerprints, so the
index is keyed by three positions and their bytes at once; 20 position triples suffice for
every four positions to contain one of them (a Turan system), so every pair that reaches
the count meets in a posting. Within a posting shared bytes are tallied, pairs below four
are left, and the rest is verified on the bits. A posting gives a spanning forest of its
links, which keeps every connection without listing all pairs.

Equal fingerprints are one entry of the index. A posting above ``POSTING_BLOCK`` entries
is cut into blocks and each pair of blocks is a group of its own, so no task holds more
than two blocks of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .support import LETTERS_LOWER, LETTERS_UPPER, stored

SEED = 42
SHINGLE = 4
MOST_BITS = 4
LEAST_BYTES = 4
POSTING_BLOCK = 4096
HASH_CHUNK = 1 << 16
_LOWER = bytes.maketrans(LETTERS_UPPER.encode(), LETTERS_LOWER.encode())


def position_triples() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that any four positions contain one of them.

    The positions form a ring of three classes (by remainder of three); a triple is taken
    if it lies in one class, or has two in a class and one in the next.
    """
    chosen = []
    for triple in combinations(range(8), 3):
        classes = [p % 3 for p in triple]
        if any(classes.count(c) == 3 or (classes.count(c) == 2 and (c + 1) % 3 in classes) for c in range(3)):
            chosen.append(triple)
    return chosen


def simhash(text: str | None) -> int:
    """The fingerprint as a signed 64-bit number; no words give zero."""
    import xxhash

    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    span = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    low, high = starts[: len(words) - span].tolist(), ends[span:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(low), HASH_CHUNK):
        part = slice(at, at + HASH_CHUNK)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(low[part], high[part])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    majority = np.packbits(2 * counts > len(low), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint)`` with the fingerprint as a long, one row per row of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([simhash(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["key", "fingerprint"])

    return rows.mapInArrow(hashed, f"key {rows.schema['key'].dataType.simpleString()}, fingerprint long")


def _forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among these fingerprints."""
    links = []
    rest = prints
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            one = frontier.pop()
            differing = rest ^ one
            tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = tally >= LEAST_BYTES
            near[near] = np.bitwise_count(differing[near].view(np.uint64)) <= MOST_BITS
            found = rest[near]
            links.extend((int(one), int(other)) for other in found)
            frontier.extend(found)
            rest = rest[~near]
    return links


def _links_of_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        values = lists.values.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        sizes = np.diff(offsets)
        first = offsets[:-1][sizes == 2]
        a, b = values[first], values[first + 1]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= MOST_BITS
        u, v = [a[near]], [b[near]]
        for k in np.flatnonzero(sizes > 2):
            links = _forest(values[offsets[k] : offsets[k + 1]])
            if links:
                pairs = np.array(links, np.int64)
                u.append(pairs[:, 0])
                v.append(pairs[:, 1])
        arrays = [pa.array(np.concatenate(x), pa.int64()) for x in (u, v)]
        yield pa.RecordBatch.from_arrays(arrays, ["u", "v"])


def fingerprint_links(distinct: DataFrame, block: int = POSTING_BLOCK) -> DataFrame:
    """Links ``(u, v)`` that connect the fingerprints as all pairs within four bits do."""
    fp = F.col("fingerprint")
    byte = [F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]

    def posting(number: int, triple: tuple[int, int, int]) -> Column:
        key = F.lit(number).cast("long")
        for p in triple:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        return key

    keys = F.array(*[posting(n, t) for n, t in enumerate(position_triples())])
    index = distinct.select(F.explode(keys).alias("posting"), "fingerprint")
    sized = index.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("posting"))).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high")))
    dealt = sized.select("posting", "fingerprint", blocks.alias("blocks"), own.alias("own")).select("posting", "fingerprint", F.explode(meet).alias("pair"))
    groups = dealt.groupBy("posting", "pair").agg(F.collect_list("fingerprint").alias("fingerprints")).filter(F.size("fingerprints") > 1)
    return groups.select("fingerprints").mapInArrow(_links_of_postings, "u long, v long").distinct()


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint, component_id)`` with the fingerprint as 16 hex digits.

    ``component_id`` is the least key whose document is reachable over links of at most
    four differing bits, the document itself included. A null or empty text and one of
    white space alone have fingerprint zero and are linked like any other. Repeated rows
    share a component; a null key is least only where a component has no other. An empty
    table gives no rows. Only the two named columns are read.
    """
    prints = stored(fingerprints(docs, text, key), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("least")), "classes")
    found = components(fingerprint_links(classes.select("fingerprint")))
    placed = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = placed.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    of_print = placed.join(least, F.col("component") == F.col("of")).select(F.col("fingerprint").alias("print"), "component_id")
    return prints.join(of_print, F.col("fingerprint") == F.col("print")).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of least key stays.

    Rows are told apart by their place too, so of repeated rows one stays; a row with a
    null key stays only where its component has no other.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("_place"), F.struct("*").alias("_row"))
    frozen = stored(numbered, "numbered")
    who = F.struct(F.col(f"_row.{key}").isNull().alias("absent"), F.col(f"_row.{key}").alias("key"), F.col("_place").alias("place"))
    found = simhash_components(frozen.select(who.alias("who"), F.col(f"_row.{text}").alias("text")), "text", "who")
    kept = found.filter(F.col("who") == F.col("component_id")).select(F.col("who.place").alias("_place"))
    return frozen.join(kept, "_place", "left_semi").select("_row.*")
