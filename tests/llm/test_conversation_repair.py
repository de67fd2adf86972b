"""Conversation repair against all scripts, and over several partitions."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermend.llm.conversation_repair import KINDS, NOTHING, ROLES, Costs, damaged, edits, endings, repair, script, transcript_hashes

SPACES = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SCHEMA = "conv_id long, turn long, role string, text string, row long, at string, place int, kinds double"


def faults(turns: list[tuple]) -> list[str]:
    seen, out = set(), []
    for _, role, text in turns:
        shown = text.strip(SPACES)
        out.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns: list[tuple], costs: Costs = Costs()) -> tuple[int, str, list[str]]:
    """(cost, audit, lines) by following every script at once, state by state."""

    def better(found, state, offer):
        if state not in found or offer[:2] < found[state][:2]:
            found[state] = offer

    def widened(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for initial in "ua":
                    if (state, initial) in NEXT:
                        better(states, NEXT[state, initial], (cost + costs.insert, audit + "I", [*lines, f"{ROLES[initial]}:"]))
        return states

    states = widened({"": (0, "", [])})
    for (_, role, text), fault in zip(turns, faults(turns), strict=True):
        after: dict = {}
        for state, (cost, audit, lines) in states.items():
            better(after, state, (cost + costs.delete, audit + "D", lines))
            if fault in ("", "t"):
                stays = cost + (costs.truncated if fault else 0)
                if (state, role[:1]) in NEXT:
                    better(after, NEXT[state, role[:1]], (stays, audit + "K", [*lines, f"{role}:{text}"]))
                for initial in "ua":
                    if (state, initial) in NEXT:
                        better(after, NEXT[state, initial], (stays + costs.rerole, audit + "R", [*lines, f"{ROLES[initial]}:{text}"]))
        states = widened(after)
    return min((states[state] for state in ("", "a") if state in states), key=lambda s: s[:2])


def expected(turns: list[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, sha256 of turns in order."""
    numbers = [t for t, _, _ in turns if t is not None]
    found = faults(turns)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    cost, audit, lines = cheapest(turns)
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return (gaps, *(found.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.sampled_from(KINDS), max_size=14).map("".join),
    st.sampled_from([Costs(), Costs(rerole=3, delete=9, insert=1, truncated=2), Costs(rerole=1, delete=1, insert=1, truncated=0), Costs(2, 5, 2, 7)]),
)
def test_scripts_are_the_cheapest_and_least(kinds, costs):
    turns = []
    for k, kind in enumerate(kinds):
        role, fault = divmod(KINDS.index(kind), 4)
        turns.append((k, ("system", "user", "assistant", "tool")[role], (f"text {k}.", f"text {k}", " ", "")[fault]))
    # Duplicates must go as blanks do, so a blank stands for both here.
    got = script(costs, kinds, NOTHING, endings(costs)) if kinds else []
    cost, audit, lines = cheapest(turns, costs)
    assert "".join(got) == audit
    made = []
    for turn, _, initial, role in edits(got, kinds, NOTHING):
        if initial != "D":
            made.append(f"{role or turns[turn][1]}:{'' if initial == 'I' else turns[turn][2]}")
    assert made == lines and cost >= 0


def conversation(seed: int, n: int) -> list[tuple]:
    chooser = random.Random(seed)
    out = []
    for k in range(n):
        role = chooser.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
        text = chooser.choice([f"Hello {k}.", f"open {k}", " \t", "", "same words!", None, f"why {k}? \n"])
        out.append((None if chooser.random() < 0.05 else k + chooser.randrange(2) * 1000, role, text))
    return out


@pytest.fixture(scope="module")
def talks() -> dict:
    found = {k: conversation(k, n) for k, n in enumerate([1, 2, 3, 5, 8, 13, 21, 34] * 4)}
    found[500] = conversation(500, 900)  # spans partitions
    found[None] = conversation(501, 7)
    return found


def in_order(turns):
    """Turns with null first; ties of one turn do not occur in these but for null, which are told apart by their digest."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]

    def key(turn):
        place = f"{len(turn[1])}:{turn[1]}{turn[2]}"
        return (turn[0] is not None, turn[0] or 0, turn[1], hashlib.md5(place.encode()).digest())

    return sorted(filled, key=key)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_conversations_of_any_length(spark, talks, partitions):
    rows = [(conv, *turn, 1, "a", 2, 3.0) for conv, turns in talks.items() for turn in turns]
    random.Random(3).shuffle(rows)
    names = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        repaired = repair(spark.createDataFrame(rows, SCHEMA))
        got = {r.conv_id: tuple(r)[1:] for r in repaired.conversations.collect()}
        hashes = {r.conv_id: r.sha256 for r in transcript_hashes(repaired.turns).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        want = expected(in_order(turns))
        assert (*got[conv], hashes.get(conv, hashlib.sha256(b"").hexdigest())) == want, conv


def test_no_rows(spark):
    repaired = repair(spark.createDataFrame([], SCHEMA))
    assert repaired.conversations.collect() == [] and repaired.turns.collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two? {t}!") for c in range(30) for t in range(4)] + [(None, None, None, None), (7, 2, "assistant", "again.")]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    want = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            shown = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(fate, text)
            want += [(conv, turn, "user" if fate == 4 else role, shown)] * (2 if fate == 3 else 1)
    assert got == sorted(want, key=str)
