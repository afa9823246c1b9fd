"""Cheapest repair of damaged conversations with Four-Russians block tables.

A repair keeps, re-roles, deletes or inserts turns so that the roles read ``(s?(ua)+)?``.
The grammar has four states, so what the rest of a conversation costs is a vector of four
numbers. Shifted to a least value of zero only a few dozen vectors occur. For each of them
and each block of four turns a table, made once per worker, holds the vector before the
block and the shift: a conversation is read backward one block at a time by lookup. The
trace then runs forward; it expands each block backward from the vector at its end, and
takes the ASCII-least edit among those that stay on a cheapest path, so ties are exact.

Conversations of any length: turns are numbered by a range partitioning and cut into pieces
of bounded size. Pieces of one conversation are joined by their cost matrices (four by
four) and by what state a trace through them ends in, one small row per piece. Duplicates
are the rows that are not the first of their role and text; both sides of that test are
aggregates, so a turn that is repeated very often is spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..ordering import global_ordinal
from .support import stored

#: Turns of a piece, and of a block of the tables.
PIECE_ROWS, BLOCK = 65_536, 4
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
INITIALS = "sua"
ENTERED = {1: "system", 2: "user", 3: "assistant"}
#: The state that a user or assistant turn leads to, and states after keeping s, u, a.
FORCED = (2, 2, 3, 2)
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
MUST_DELETE, SYMBOLS = 8, 9
NEVER = 1 << 50
NONE, TRUNCATED, EMPTY, DUPLICATE = 0, 1, 2, 3

Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs from each state, insertions at this place included."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[FORCED[s]]) for s, c in enumerate(costs)]
    return [min(c, NEVER) for c in costs]


def _shifted(costs: list[int]) -> tuple[Vector, int]:
    least = min(costs)
    return tuple(c if c >= NEVER else c - least for c in costs), least


def options(state: int, symbol: int) -> Iterator[tuple[str, int, int]]:
    """Edits of one turn: letter, cost and next state, in ASCII order (without insertions)."""
    yield "D", DELETE, state
    if symbol != MUST_DELETE:
        cut, role = (CUT, symbol - 4) if symbol >= 4 else (0, symbol)
        if role in KEPT[state]:
            yield "K", cut, KEPT[state][role]
        yield "R", REROLE + cut, FORCED[state]


def step_back(after: Vector, symbol: int) -> tuple[Vector, int]:
    """The shifted vector before a turn and the shift, from the vector after it."""
    return _shifted(_with_inserts([min(c + after[t] for _, c, t in options(s, symbol)) for s in range(4)]))


class BlockTables:
    """All vectors that occur, and their transitions over single turns and whole blocks."""

    def __init__(self) -> None:
        units = [_with_inserts([0 if s == j else NEVER for s in range(4)]) for j in range(4)]
        starts = [_with_inserts([0, NEVER, NEVER, 0]), *units]
        self.vectors: list[Vector] = []
        self.number: dict[Vector, int] = {}
        self.shift_of_start, self.start = [], []
        for costs in starts:
            vector, shift = _shifted(costs)
            self.start.append(self._add(vector))
            self.shift_of_start.append(shift)
        single, index = [], 0
        while index < len(self.vectors):
            moves = [step_back(self.vectors[index], symbol) for symbol in range(SYMBOLS)]
            single.append([(self._add(vector), shift) for vector, shift in moves])
            index += 1
        one = np.array(single)
        following, shifts = one[:, :, 0], one[:, :, 1]
        for _ in range(BLOCK - 1):
            # A turn in front of every block that is tabled so far.
            longer = one[following]
            following = longer[:, :, :, 0].transpose(0, 2, 1).reshape(len(one), -1)
            shifts = (shifts[:, None, :] + longer[:, :, :, 1].transpose(0, 2, 1)).reshape(len(one), -1)
        self.single, self.following, self.shifts = single, following.tolist(), shifts.tolist()
        self.expanded: dict[tuple[int, int, int], tuple[str, list[int], int]] = {}

    def _add(self, vector: Vector) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def borders(self, symbols: list[int], last: int) -> tuple[list[int], list[int], int, int]:
        """Vectors after the odd first turns and after each block, from the vector at the end.

        Returns the block codes, the vector at the end of each block, that at the start of
        the first block, and the sum of shifts.
        """
        odd = len(symbols) % BLOCK
        codes = []
        for at in range(odd, len(symbols), BLOCK):
            code = 0
            for symbol in symbols[at : at + BLOCK]:
                code = code * SYMBOLS + symbol
            codes.append(code)
        ends, total, vector = [0] * len(codes), 0, last
        for index in range(len(codes) - 1, -1, -1):
            ends[index] = vector
            total += self.shifts[vector][codes[index]]
            vector = self.following[vector][codes[index]]
        return codes, ends, vector, total

    def expand(self, state: int, symbols: list[int], last: int) -> tuple[str, list[int], int]:
        """Edits of some turns on a cheapest path: letters, states after each, final state.

        Vectors are made backward from ``last``; of several cheapest edits the ASCII-least
        is taken, and an insertion (I) comes before the turn it stands in front of.
        """
        inner = [last]
        for symbol in reversed(symbols):
            inner.append(self.single[inner[-1]][symbol][0])
        inner.reverse()
        letters, states = [], []
        for at, symbol in enumerate(symbols):
            before, after = self.vectors[inner[at]], self.vectors[inner[at + 1]]
            shift = self.single[inner[at + 1]][symbol][1]
            while True:
                moves = [("I", None, FORCED[state])] if INSERT + before[FORCED[state]] == before[state] else []
                moves += [(e, c, t) for e, c, t in options(state, symbol) if c + after[t] == before[state] + shift]
                letter, cost, state = min(moves)
                letters.append(letter)
                states.append(state)
                if cost is not None:
                    break
        return "".join(letters), states, state

    def trace(self, symbols: list[int], entry: int, last: int) -> tuple[str, list[int], int]:
        """Edits of a piece that is entered in a state and followed by a vector."""
        codes, ends, vector, _ = self.borders(symbols, last)
        odd = len(symbols) % BLOCK
        text, states, state = self.expand(entry, symbols[:odd], vector)
        texts, states = [text], list(states)
        for index, code in enumerate(codes):
            key = (state, ends[index], code)
            if key not in self.expanded:
                at = odd + index * BLOCK
                self.expanded[key] = self.expand(state, symbols[at : at + BLOCK], ends[index])
            text, more, state = self.expanded[key]
            texts.append(text)
            states.extend(more)
        return "".join(texts), states, state

    def closing(self, state: int) -> list[int]:
        """States entered by the insertions at the end of a conversation."""
        entered, end = [], self.vectors[self.start[0]]
        while end[state]:
            state = FORCED[state]
            entered.append(state)
        return entered

    def matrix(self, symbols: list[int]) -> list[int]:
        """Least costs from state to state through a piece, row by row."""
        rows = [[NEVER] * 4 for _ in range(4)]
        for target in range(4):
            codes, _, vector, total = self.borders(symbols, self.start[1 + target])
            total += self.shift_of_start[1 + target]
            for symbol in reversed(symbols[: len(symbols) % BLOCK]):
                vector, shift = self.single[vector][symbol]
                total += shift
            for state, cost in enumerate(self.vectors[vector]):
                rows[state][target] = min(NEVER, cost + total)
        return [cost for row in rows for cost in row]

    def through(self, matrix: list[int], vector: int) -> int:
        """The vector in front of a piece from the vector behind it."""
        after = self.vectors[vector]
        costs = [min(NEVER, min(matrix[4 * s + t] + after[t] for t in range(4))) for s in range(4)]
        return self.number[_shifted(costs)[0]]


@cache
def tables() -> BlockTables:
    """The tables of this worker."""
    return BlockTables()


def symbol_of(code: int) -> int:
    """Symbol of a turn from its initial (0 to 3) plus four times its fault."""
    initial, fault = code % 4, code // 4
    return MUST_DELETE if fault >= EMPTY else initial + 4 * fault


def _rows(df: DataFrame, change: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """``change`` applied to every row, in Arrow batches."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([out for row in batch.to_pylist() for out in change(row)], schema=arrow)

    return df.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied
    (1), stripped of ``.!?`` (2), repeated (3) or given to the user (4). Nulls are one blank;
    a null turn stays null."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(name) % 20
    text = F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        kind.alias("_kind"),
    )
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("_kind <> 0").withColumn("_copy", F.explode(copies)).drop("_kind", "_copy")


def _conversation(conv: str) -> Column:
    """The conversation as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


@dataclass(frozen=True)
class Repairs:
    """Facts of all turns, the edits by piece, and the turns' texts."""

    facts: DataFrame
    pieces: DataFrame
    texts: DataFrame

    def edits(self) -> DataFrame:
        """``(conv_id, piece, step, edit, role, text)`` for every edit in order.

        ``role`` is that of the turn after the edit, ``text`` its text; both are null for
        deletions. Inserted turns have an empty text.
        """
        steps = self.pieces.select("_conv", "conv_id", "piece", F.posexplode(F.arrays_zip(F.split("edits", "").alias("edit"), F.col("states").alias("state"), F.col("idents").alias("ident"))).alias("step", "e"))
        steps = steps.select("_conv", "conv_id", "piece", "step", "e.*").withColumn(
            "entered", F.element_at(F.create_map(*[F.lit(v) for kv in ENTERED.items() for v in kv]), F.col("state"))
        )
        same = ["_conv", "ident"]
        found = steps.filter("edit IN ('K', 'R')").join(self.texts, same)
        columns = ["_conv", "conv_id", "piece", "step", "edit"]
        none = F.lit(None).cast("string")
        return (
            found.select(*columns, F.when(F.col("edit") == "K", F.col("_role")).otherwise(F.col("entered")).alias("role"), F.col("_text").alias("text"))
            .unionByName(steps.filter("edit = 'I'").select(*columns, F.col("entered").alias("role"), F.lit("").alias("text")))
            .unionByName(steps.filter("edit = 'D'").select(*columns, none.alias("role"), none.alias("text")))
        )

    def conversations(self) -> DataFrame:
        """The repaired turns, in order of ``piece`` and ``step``."""
        return self.edits().filter("edit <> 'D'")

    def summaries(self) -> DataFrame:
        """Per conversation: faults, ``gaps``, ``illegal``, ``cost`` and ``audit``.

        The audit of a conversation is as long as its edits; the pieces' texts are put
        together in one row.
        """
        turns = F.col("turn").cast("decimal(20,0)")
        span = F.max(turns) - F.min(turns) + 1 - F.count_distinct(F.col("turn"))
        zero, most = (F.lit(k).cast("decimal(20,0)") for k in (0, (1 << 63) - 1))
        gaps = F.least(F.coalesce(span, zero), most).cast("long")
        counts = [F.count_if(F.col("fault") == k).alias(n) for n, k in (("blank", EMPTY), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))]
        faults = self.facts.groupBy("_conv").agg(gaps.alias("gaps"), *counts)
        parts = F.array_sort(F.collect_list(F.struct("piece", "edits")))
        audits = self.pieces.groupBy("_conv").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda p: p["edits"]), "").alias("audit")
        )
        return faults.join(audits, "_conv")


def _facts(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with their faults, and role and text by conversation and identity."""
    named = F.coalesce(F.col(role), F.lit(" "))
    said = F.coalesce(F.col(text), F.lit(" "))
    ident = F.unhex(F.sha2(F.concat(F.length(named).cast("string"), F.lit(":"), named, said), 256))
    plain = rows.select(
        _conversation(conv).alias("_conv"), F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), ident.alias("ident"), named.alias("_role"), said.alias("_text")
    )
    shown = F.rtrim(F.col("_text"), F.lit(BLANK_CHARACTERS))
    first = F.substring("_role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    own = F.when(shown == "", EMPTY).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(TRUNCATED)
    # Equal turns are told apart by a hash of their place, so that many of them spread.
    slim = plain.select("_conv", "conv_id", "turn", "ident", initial.alias("initial"), own.alias("own"), F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    numbered = global_ordinal(slim, ["_conv", "turn", "ident", "_salt"]).drop("_salt")
    firsts = numbered.groupBy("_conv", "ident").agg(F.min("ordinal").alias("ordinal")).select("ordinal", F.lit(True).alias("_first"))
    fault = F.when(F.col("own") == EMPTY, EMPTY).when(F.col("_first").isNull(), DUPLICATE).otherwise(F.col("own"))
    facts = numbered.join(firsts, "ordinal", "left").withColumn("fault", fault).drop("own", "_first")
    texts = plain.groupBy("_conv", "ident").agg(F.first("_role").alias("_role"), F.first("_text").alias("_text"))
    return facts, texts


def _cut(facts: DataFrame, piece_rows: int) -> DataFrame:
    """One row per conversation and piece with its codes in order, and the initial before it."""
    code = (F.col("initial") + 4 * F.col("fault")).cast("int")
    piece = F.floor(F.col("ordinal") / F.lit(piece_rows)).cast("long")
    last = F.col("ordinal") % piece_rows == piece_rows - 1
    places = F.when(last, F.array(piece, piece + 1)).otherwise(F.array(piece))
    spread = facts.select("_conv", "conv_id", "ordinal", code.alias("code"), "ident", piece.alias("own"), F.explode(places).alias("piece"))
    turn = F.struct("ordinal", "code", F.when(F.col("own") == F.col("piece"), F.col("ident")).alias("ident"))
    grouped = spread.groupBy("_conv", "piece").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns"))
    mine = F.filter("turns", lambda t: t["ident"].isNotNull())
    before = F.filter("turns", lambda t: t["ident"].isNull())
    return grouped.select(
        "_conv",
        "piece",
        "conv_id",
        F.transform(mine, lambda t: t["code"]).alias("codes"),
        F.transform(mine, lambda t: t["ident"]).alias("idents"),
        (F.get(before, F.lit(0))["code"] % 4).alias("before"),
    ).filter(F.size("codes") > 0)


def _borders(pieces: DataFrame) -> DataFrame:
    """``(_conv, piece, entry, last)`` of the pieces of conversations that have several.

    Cost matrices of the pieces give the vector behind each piece, going backward; the
    states that traces end in give the state in front of each, going forward.
    """
    several = pieces.groupBy("_conv").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_conv")
    parts = stored(pieces.join(several, "_conv", "left_semi").select("_conv", "piece", "codes"), "conversation-parts")

    def matrices(row: dict) -> Iterator[dict]:
        yield {"_conv": row["_conv"], "piece": row["piece"], "matrix": tables().matrix([symbol_of(c) for c in row["codes"]])}

    def backward(row: dict) -> Iterator[dict]:
        vector = tables().start[0]
        for part in reversed(row["parts"]):
            yield {"_conv": row["_conv"], "piece": part["piece"], "last": vector, "end": part is row["parts"][-1]}
            vector = tables().through(part["matrix"], vector)

    def exits(row: dict) -> Iterator[dict]:
        symbols = [symbol_of(c) for c in row["codes"]]
        states = [tables().trace(symbols, s, row["last"])[2] for s in range(4)]
        yield {"_conv": row["_conv"], "piece": row["piece"], "last": row["last"], "end": row["end"], "states": states}

    def forward(row: dict) -> Iterator[dict]:
        state = 0
        for part in row["parts"]:
            yield {"_conv": row["_conv"], "piece": part["piece"], "entry": state, "last": part["last"], "end": part["end"]}
            state = part["states"][state]

    def chained(df: DataFrame, *columns: str) -> DataFrame:
        return df.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct("piece", *columns))).alias("parts"))

    key = "_conv string, piece bigint"
    costs = _rows(parts, matrices, f"{key}, matrix array<bigint>")
    behind = _rows(chained(costs, "matrix"), backward, f"{key}, last int, end boolean")
    ended = _rows(parts.join(behind, ["_conv", "piece"]), exits, f"{key}, last int, end boolean, states array<int>")
    return _rows(chained(ended, "last", "end", "states"), forward, f"{key}, entry int, last int, end boolean")


def repair_conversations(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_rows: int = PIECE_ROWS
) -> Repairs:
    """The cheapest repair of every conversation; of equal ones the ASCII-least edits.

    Turns are ordered by ``turn``, nulls first, and within a turn by a hash of role and
    text, so equal rows stand together. Null roles and texts are one blank. A null
    conversation is one of its own. An empty role can only be replaced or deleted. A
    turn's first fault counts: blank, duplicate (role and text seen earlier), truncated.
    Blank and duplicate turns must go. An empty table gives no rows. Other columns are
    not read.
    """
    facts, texts = _facts(rows, conv, turn, role, text)
    facts = stored(facts, "conversation-facts")
    pieces = stored(_cut(facts, piece_rows), "conversation-pieces")
    split = pieces.groupBy("_conv").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if split.isEmpty():
        placed = pieces.withColumns({"entry": F.lit(0), "last": F.lit(None).cast("int"), "end": F.lit(True)})
    else:
        placed = pieces.join(_borders(pieces), ["_conv", "piece"], "left")
    kind = dict(pieces.dtypes)["conv_id"]

    def edit(row: dict) -> Iterator[dict]:
        table = tables()
        symbols = [symbol_of(c) for c in row["codes"]]
        last = table.start[0] if row["last"] is None else row["last"]
        letters, states, state = table.trace(symbols, row["entry"] or 0, last)
        if row["end"] is not False:
            closing = table.closing(state)
            letters, states = letters + "I" * len(closing), states + closing
        idents, kept_cuts, turns = [], 0, iter(zip(row["idents"], symbols, strict=True))
        for letter in letters:
            ident, symbol = (None, None) if letter == "I" else next(turns)
            idents.append(ident)
            kept_cuts += letter in "KR" and symbol >= 4
        price = DELETE * letters.count("D") + REROLE * letters.count("R") + INSERT * letters.count("I") + CUT * kept_cuts
        shown = [c % 4 for c in row["codes"]]
        pairs = zip(([] if row["before"] is None else [row["before"]]) + shown[:-1], shown[0 if row["before"] is not None else 1 :])
        illegal = sum(p not in ((0, 1), (1, 2), (2, 1)) for p in pairs)
        yield {k: row[k] for k in ("_conv", "conv_id", "piece")} | {"edits": letters, "states": states, "idents": idents, "cost": price, "illegal": illegal}

    schema = f"_conv string, conv_id {kind}, piece bigint, edits string, states array<int>, idents array<binary>, cost bigint, illegal bigint"
    return Repairs(facts, stored(_rows(placed, edit, schema), "conversation-edits"), texts)


def transcript_digests(turns: DataFrame) -> DataFrame:
    """``(_conv, repaired_sha256)`` of ``role:text`` lines in order.

    A digest reads its conversation from front to back, so that is done by one task per
    conversation; it streams over sorted rows and holds one hash state.
    """
    line = F.concat_ws(":", "role", "text").alias("line")
    ordered = turns.select("_conv", "piece", "step", line).repartition("_conv").sortWithinPartitions("_conv", "piece", "step")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if conv != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(current, state.hexdigest())])

    return ordered.mapInArrow(digest, "_conv string, repaired_sha256 string")


def _digest_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["_conv", "repaired_sha256"])


def repair_report(conversations: DataFrame, *, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Damage conversations, repair them, and report one row per original conversation.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` (long), ``audit`` and
    ``repaired_sha256``. A conversation that loses all its rows has zeros, an empty audit
    and the hash of nothing, and so has one whose repair is empty (but for its counts).
    """
    repairs = repair_conversations(damaged(conversations), piece_rows=piece_rows)
    everything = conversations.select(_conversation("conv_id").alias("_conv"), "conv_id").distinct()
    reports = repairs.summaries().join(transcript_digests(repairs.conversations()), "_conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return everything.join(reports, "_conv", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
