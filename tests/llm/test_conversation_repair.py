"""Conversation repair against all cheapest edit sequences, and odd conversations."""

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from runloom.llm import queries as q
from runloom.llm.conversation_repair import damaged, repair_conversations, repair_report, tables

SMALL = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")
FULL = {"u": "user", "a": "assistant"}


def all_cheapest(turns):
    """``turns`` are (initial, must go, cut); all cheapest edits with the roles they give."""
    n = len(turns)

    def follows(roles):
        """Whether the role initials can be continued to the grammar, and whether they are complete."""
        if roles == "" or roles == "s":
            return True, roles == ""
        body = roles[1:] if roles[0] == "s" else roles
        return bool(re.fullmatch("(ua)*u?", body)), bool(GRAMMAR.fullmatch(roles))

    @cache
    def best(at, state):
        """Least cost from turn ``at`` on and every (letters, roles) that has it; ``state`` is the last role."""
        found = [(0, {("", "")})] if at == n and follows(state)[1] else []
        moves = []
        if at < n:
            initial, must_go, cut = turns[at]
            moves.append(("D", 2, "", at + 1))
            if not must_go:
                moves.append(("K", 5 * cut, initial, at + 1))
                moves += [("R", 1 + 5 * cut, r, at + 1) for r in "ua"]
        moves += [("I", 5, r, at) for r in "ua"] if inserted[0] < 3 else []
        for letter, cost, role, after in moves:
            # Roles so far matter only by their last one, written as the shortest such text.
            roles = state + role
            if not follows(roles)[0]:
                continue
            short = {"": state, "s": "s", "u": "u", "a": "ua"}[role]
            inserted[0] += letter == "I"
            rest, ways = best(after, short) if letter != "I" else best.__wrapped__(after, short)
            inserted[0] -= letter == "I"
            found.append((cost + rest, {(letter + a, role + b) for a, b in ways}))
        if not found:
            return 1 << 40, set()
        least = min(c for c, _ in found)
        return least, set().union(*(w for c, w in found if c == least))

    inserted = [0]
    return best(0, "")


def brute_report(rows, conv):
    """The contract for one conversation of (turn, role, text, file order) rows."""
    after = []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    seen, turns, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in after:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        turns.append((role[:1] or "-", fault in ("blank", "duplicate"), fault == "truncated"))
    known = [t for t, _, _ in after if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(after))
    cost, ways = all_cheapest(turns)
    audit, roles = min(ways)
    lines, left, entered = [], iter(after), iter(roles)
    for letter in audit:
        turn = None if letter == "I" else next(left)
        if letter == "D":
            continue
        role = next(entered)
        lines.append(f"{turn[1] if letter == 'K' else FULL[role]}:{turn[2] if turn else ''}")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)


def grouped(rows):
    found = {}
    for r in rows:
        found.setdefault(r[0], []).append(tuple(r[1:4]))
    return found


def compare(rows, report):
    expected = {conv: brute_report(turns, conv) for conv, turns in grouped(rows).items()}
    got = {r[0]: tuple(r[1:]) for r in report.collect()}
    assert report.count() == len(got) == len(expected)
    for conv in expected:
        assert got[conv] == expected[conv], conv


def test_blocks_equal_single_steps():
    table, chance = tables(), random.Random(5)
    for _ in range(300):
        symbols = [chance.randrange(9) for _ in range(chance.randrange(12))]
        turns = [("sua-"[s % 4], s == 8, 4 <= s < 8) for s in symbols]
        cost, ways = all_cheapest(turns)
        text, states, state = table.trace(symbols, 0, table.start[0])
        closing = table.closing(state)
        assert text + "I" * len(closing) == min(ways)[0]
        codes, _, vector, total = table.borders(symbols, table.start[0])
        first = symbols[: len(symbols) % 4]
        for s in reversed(first):
            vector, shift = table.single[vector][s]
            total += shift
        assert total + table.vectors[vector][0] == cost


def test_whole_query(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    compare(rows, q.QUERIES["op11_conversation_repair"](spark, SMALL))


@pytest.fixture(scope="module")
def odd(spark):
    chance, rows = random.Random(3), []
    texts = ["Fine.", "Why?", "open end", "", " \t\n", None, "Good!  ", "é.", "x"]
    for conv in [*range(12), None]:
        for turn in range(chance.randrange(1, 9)):
            at = None if chance.random() < 0.1 else turn * chance.choice((1, 1, 3))
            rows.append((conv, at, chance.choice(["user", "assistant", "system", "tool", None, "User"]), chance.choice(texts)))
    # One row a turn, as order within a turn is by hash.
    unique = {(r[0], r[1]): r for r in rows}
    return list(unique.values()) + [(99, 1, "user", "dropped?"), (50, None, None, None), (51, -5, "assistant", "Alone.")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("piece_rows", [3, 5, 65_536])
def test_pieces_of_any_size(spark, odd, piece_rows):
    table = spark.createDataFrame(odd, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("_conv", "ident", "piece", "fault", "edits", "ordinal")])
    compare(odd, repair_report(table, piece_rows=piece_rows))


def test_repeated_and_long(spark):
    many = [(1, k, ("user", "assistant")[k % 2], f"Turn number {k}.") for k in range(400)]
    many += [(2, 7, "user", "Same.")] * 50
    report = {r.conv_id: r for r in repair_report(spark.createDataFrame(many, SCHEMA), piece_rows=64).collect()}
    assert report[1].cost == brute_cost(many[:400]) and report[1].audit.count("D") >= 1
    copies = len(damage_of(many[400:]))
    assert report[2].duplicate == copies - 1 and report[2].audit.count("D") >= copies - 1


def brute_cost(rows):
    """Least cost by the plain table over turns and states."""
    after, kept = damage_of(rows), {0: 0, 1: 1 << 40, 2: 1 << 40, 3: 1 << 40}
    forced = {0: 2, 1: 2, 2: 3, 3: 2}

    def grow(costs):
        for _ in range(3):
            for s, t in forced.items():
                costs[t] = min(costs[t], costs[s] + 5)
        return costs

    kept = grow(kept)
    for initial, must_go, cut in after:
        new = {s: c + 2 for s, c in kept.items()}
        for s, c in kept.items():
            if must_go:
                continue
            target = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(s)
            if target is not None:
                new[target] = min(new[target], c + 5 * cut)
            new[forced[s]] = min(new[forced[s]], c + 1 + 5 * cut)
        kept = grow(new)
    return min(kept[0], kept[3])


def damage_of(rows):
    out, seen = [], set()
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            gone = not text.strip() or (role, text) in seen
            seen.add((role, text))
            out.append((role[0], gone, not gone and text[-1] not in ".!?"))
    return out


def test_empty_table_and_edits(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_report(empty).collect() == []
    rows = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Ok.")], SCHEMA)
    turns = repair_conversations(rows).edits().orderBy("piece", "step").collect()
    assert [(t.edit, t.role, t.text) for t in turns] == [
        ("K", "system", "Be kind."), ("K", "user", "Hi."), ("D", None, None), ("R", "assistant", "Ok."),
    ]
    assert damaged(empty).collect() == []
