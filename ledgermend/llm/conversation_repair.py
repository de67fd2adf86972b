"""Conversation structure repair: cheapest edits by Hirschberg's divide and conquer.

A repaired conversation has the roles (system?)(user assistant)+, or no turn at all. Four states follow it: nothing yet,
after the system, a user's or an assistant's turn. An edit keeps, reroles or deletes a turn or inserts an empty one, and its
initial alone decides the next state, so of all cheapest edit scripts the one with the least initials is unique.

A stretch of turns is halved: costs run forward from its first state and backward from its end as vectors of four, and meet
in the middle; the crossing is the cheapest state, of several the one with the least script so far. For that the
forward vector also ranks the four scripts, which needs no script: inserts count to the turn that follows, so no script
is the beginning of another one. Both halves are solved alike, in space proportional to the vectors.

The same vectors split a conversation of any length over tasks. Turns are put in order by a range partitioning; each
stretch of a conversation in one partition is summed up by four forward vectors, one for each state it can begin with;
the summaries of a conversation, one row for each stretch, give the states at which the stretches meet; then each
stretch is solved where it lies. No task holds the turns of a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.store import written

#: White space, ends of a whole sentence, the roles of a repaired conversation.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = {"s": "system", "u": "user", "a": "assistant"}

NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
INITIALS = "sua"
_KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
#: What a made turn (rerole or insert) is in each state, and the state after it.
_MADE = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_DONE = (NOTHING, ASSISTANT)

FINE, TRUNCATED, BLANK, DUPLICATE = FAULTS = range(4)
#: A turn's kind is a letter: 4 * place of its role's initial in "sua" (3: another one) + fault.
KINDS = "ABCDEFGHIJKLMNOP"
_ROLE_OF_KIND = str.maketrans({kind: (INITIALS + "-")[k // 4] for k, kind in enumerate(KINDS)})

Vector = tuple[tuple[int, int] | None, ...]
"""For each state its cost and the rank of its script among the four; None where no script leads."""


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    """What a truncated turn costs if it stays."""


@lru_cache(maxsize=None)
def steps(costs: Costs, kind: str, state: int) -> dict[int, tuple[int, str]]:
    """For each state after a turn of a kind: the least cost, and of that the least initials, inserts before it included."""
    role, fault = divmod(KINDS.index(kind), 4)
    found: dict[int, tuple[int, str]] = {}
    for inserts in range(4):
        spent, initials = inserts * costs.insert, "I" * inserts
        offers = [(state, spent + costs.delete, initials + "D")]
        if fault < BLANK:
            stays = spent + (costs.truncated if fault == TRUNCATED else 0)
            offers.append((_MADE[state][1], stays + costs.rerole, initials + "R"))
            after = _KEPT.get((state, INITIALS[role : role + 1]))
            if after is not None:
                offers.append((after, stays, initials + "K"))
        for after, *offer in offers:
            found[after] = min(found.get(after, tuple(offer)), tuple(offer))
        state = _MADE[state][1]
    return found


@lru_cache(maxsize=None)
def endings(costs: Costs) -> dict[int, tuple[int, str]]:
    """What it takes to end a conversation in each state."""
    out = {}
    for state in STATES:
        at, inserts = state, 0
        while at not in _DONE:
            at, inserts = _MADE[at][1], inserts + 1
        out[state] = (inserts * costs.insert, "I" * inserts)
    return out


def _ranked(best: dict[int, tuple]) -> Vector:
    """States with (cost, *script) as a vector."""
    order = sorted(best, key=lambda state: best[state][1:])
    return tuple((best[state][0], order.index(state)) if state in best else None for state in STATES)


def _lowered(vector: Vector) -> tuple[int, Vector]:
    """A vector's least cost, and the vector with costs above it: few different ones occur."""
    least = min(entry[0] for entry in vector if entry)
    return least, tuple(entry and (entry[0] - least, entry[1]) for entry in vector)


@lru_cache(maxsize=1 << 16)
def _ahead(costs: Costs, vector: Vector, kind: str) -> tuple[int, Vector]:
    best: dict[int, tuple] = {}
    for state, entry in enumerate(vector):
        if entry:
            for after, (cost, initials) in steps(costs, kind, state).items():
                offer = (entry[0] + cost, entry[1], initials)
                best[after] = min(best.get(after, offer), offer)
    return _lowered(_ranked(best))


def forward(costs: Costs, kinds: str, state: int) -> Vector:
    """The vector after turns of these kinds that begin in a state."""
    vector: Vector = tuple((0, 0) if s == state else None for s in STATES)
    total = 0
    for kind in kinds:
        more, vector = _ahead(costs, vector, kind)
        total += more
    return tuple(entry and (entry[0] + total, entry[1]) for entry in vector)


@lru_cache(maxsize=1 << 16)
def _back(costs: Costs, after: tuple[int | None, ...], kind: str) -> tuple[int, tuple[int | None, ...]]:
    found = []
    for state in STATES:
        offers = [cost + after[to] for to, (cost, _) in steps(costs, kind, state).items() if after[to] is not None]
        found.append(min(offers, default=None))
    least = min(cost for cost in found if cost is not None)
    return least, tuple(cost if cost is None else cost - least for cost in found)


def backward(costs: Costs, kinds: str, end: dict[int, tuple[int, str]]) -> tuple[int | None, ...]:
    """The cost of each state before turns of these kinds, given what each state costs after them."""
    vector = tuple(end[state][0] if state in end else None for state in STATES)
    total = 0
    for kind in reversed(kinds):
        more, vector = _back(costs, vector, kind)
        total += more
    return tuple(cost if cost is None else cost + total for cost in vector)


def crossing(ahead: Vector, behind: tuple[int | None, ...]) -> int:
    """The state at which a cheapest script with the least initials passes."""
    offers = [(a[0] + b, a[1], state) for state, (a, b) in enumerate(zip(ahead, behind, strict=True)) if a and b is not None]
    return min(offers)[2]


def script(costs: Costs, kinds: str, state: int, end: dict[int, tuple[int, str]]) -> list[str]:
    """For each turn the initials of its edits, inserts before it included; those after the last turn belong to it."""
    out: list[str] = []
    todo = [(0, len(kinds), state, end)]
    while todo:
        low, high, first, last = todo.pop()
        if high - low == 1:
            offers = [(cost + last[to][0], initials + last[to][1]) for to, (cost, initials) in steps(costs, kinds[low], first).items() if to in last]
            out.append(min(offers)[1])
        elif high > low:
            mid = (low + high) // 2
            meet = crossing(forward(costs, kinds[low:mid], first), backward(costs, kinds[mid:high], last))
            todo += [(mid, high, meet, last), (low, mid, first, {meet: (0, "")})]
    return out


def edits(scripts: list[str], kinds: str, state: int) -> Iterator[tuple[int, int, str, str | None]]:
    """(turn, place, initial, role) of each edit of a stretch that begins in a state; the role of kept turns is None."""
    for turn, initials in enumerate(scripts):
        for place, initial in enumerate(initials):
            if initial == "D":
                yield turn, place, initial, None
            elif initial == "K":
                state = _KEPT[state, INITIALS[KINDS.index(kinds[turn]) // 4]]
                yield turn, place, initial, None
            else:
                role, state = _MADE[state]
                yield turn, place, initial, ROLES[role]


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SUMMARY = pa.schema(
    [(name, pa.list_(pa.int64())) for name in ("costs", "ranks")] + [(name, pa.string()) for name in ("first", "last")] + [(name, pa.int64()) for name in _COUNTS]
)


def _summary(costs: Costs, kinds: str) -> dict:
    """The vectors of a stretch for each state it can begin with, its outer roles, and its counts."""
    vectors = [forward(costs, kinds, state) for state in STATES]
    roles = kinds.translate(_ROLE_OF_KIND)
    faults = {name: sum(map(kinds.count, KINDS[fault::4])) for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}
    return {
        "costs": [entry and entry[0] for vector in vectors for entry in vector],
        "ranks": [entry and entry[1] for vector in vectors for entry in vector],
        "first": roles[0],
        "last": roles[-1],
        "illegal": len(roles) - 1 - sum(map(roles.count, _LEGAL)),
        **faults,
    }


def _summaries(costs: Costs):
    def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.RecordBatch.from_pylist([_summary(costs, kinds) for kinds in batch["kinds"].to_pylist()], _SUMMARY)
            yield pa.RecordBatch.from_arrays([*batch.columns, *made.columns], [*batch.schema.names, *made.schema.names])

    return summed_up


def _meeting(costs: Costs, stretches: list[dict]) -> Iterator[dict]:
    """For the stretches of one conversation: the states where each begins and ends (null: the end), and the whole cost."""
    vector: Vector = tuple((0, 0) if state == NOTHING else None for state in STATES)
    before: list[dict[int, int]] = []
    for stretch in stretches:
        best: dict[int, tuple] = {}
        for state, entry in enumerate(vector):
            for after in STATES if entry else ():
                cost = stretch["costs"][4 * state + after]
                if cost is not None:
                    offer = (entry[0] + cost, entry[1], stretch["ranks"][4 * state + after], state)
                    best[after] = min(best.get(after, offer), offer)
        before.append({after: offer[3] for after, offer in best.items()})
        vector = _ranked({after: offer[:3] for after, offer in best.items()})
    behind = tuple(endings(costs)[state][0] for state in STATES)
    state = crossing(vector, behind)
    cost, end, made = vector[state][0] + behind[state], None, []
    for stretch, came in zip(reversed(stretches), reversed(before), strict=True):
        made.append({"begin": came[state], "end": end})
        state = end = came[state]
    for k, (stretch, states) in enumerate(zip(stretches, reversed(made), strict=True)):
        apart = k > 0 and stretches[k - 1]["last"] + stretch["first"] not in _LEGAL
        yield {"conv_id": stretch["conv_id"], "piece": stretch["piece"], **states, "cost": cost, "joint": int(apart)}


_MEETING = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("joint", pa.int64())])


def _chains(costs: Costs):
    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[dict] = []
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                if own and own[0]["conv_id"] != row["conv_id"]:
                    out += _meeting(costs, own)
                    own = []
                own.append(row)
            yield pa.RecordBatch.from_pylist(out, _MEETING)
        if own:
            yield pa.RecordBatch.from_pylist(list(_meeting(costs, own)), _MEETING)

    return chained


_EDITS = pa.schema([("at", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string())])


def _solved(costs: Costs):
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scripts = []
            for kinds, begin, end in zip(*(batch[name].to_pylist() for name in ("kinds", "begin", "end")), strict=True):
                scripts.append(script(costs, kinds, begin, endings(costs) if end is None else {end: (0, "")}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scripts, pa.list_(pa.string()))], [*batch.schema.names, "scripts"])

    return solved


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, scripts, kinds, begin in zip(*(batch[name].to_pylist() for name in ("start", "scripts", "kinds", "begin")), strict=True):
            found = list(zip(*edits(scripts, kinds, begin), strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array([start + turn for turn in found[0]], pa.int64()), *map(pa.array, found[1:3], (pa.int64(), pa.string())), pa.array(found[3], pa.string())], schema=_EDITS)


@dataclass(frozen=True)
class Repair:
    """conversations: a row for each conversation; turns: its repaired turns by at and place."""

    conversations: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, costs: Costs = Costs()) -> Repair:
    """Repairs the conversations of rows (conv_id, turn, role, text).

    Turns are in order of turn (null first), then of role and a digest of role and text. A turn's first fault counts:
    blank (no character but white space), duplicate (role and text seen earlier in the conversation), truncated (the last
    character that is not white space ends no sentence). Blank and duplicate turns must go. Null roles and texts count as one space, so a
    null text is blank. Rows without conv_id are a conversation of their own. Extra columns are ignored; an empty
    table gives no rows.

    conversations: conv_id, gaps (turn numbers left out between least and largest, null ones ignored), blank, duplicate,
    truncated, illegal (neighbouring roles whose initials are not su, ua or au), cost, audit (initials of all edits in order; the least
    of the cheapest). turns: conv_id, at, place (order), edit, role, text; inserted turns have an empty text.
    """
    filled = [F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")]
    turns = written(rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *filled, F.monotonically_increasing_id().alias("row")), "turns")
    place = F.when(F.substring("role", 1, 1) == "s", 0).when(F.substring("role", 1, 1) == "u", 1).when(F.substring("role", 1, 1) == "a", 2).otherwise(3)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    small = turns.select(
        "conv_id", "turn", "row", "role", place.alias("initial"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))).alias("digest"),
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("cut"),
    )
    keys = ("conv_id", "turn", "role", "digest", "row")
    # The last key spreads equal rows too. Written, as later steps need one and the same order.
    order = written(
        small.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("conv_id", "turn", "row", "initial", "digest", "blank", "cut", F.spark_partition_id().cast("long").alias("piece"), F.monotonically_increasing_id().alias("at")),
        "order",
    )
    first = order.groupBy("conv_id", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    marked = order.join(first, "at", "left").select("conv_id", "piece", "at", "initial", fault.alias("fault"))
    kind = F.substring(F.lit(KINDS), F.col("initial") * 4 + F.col("fault") + 1, F.lit(1))
    stretches = (
        marked.withColumn("kind", kind).groupBy("conv_id", "piece")
        .agg(F.min("at").alias("start"), F.expr("listagg(kind, '') WITHIN GROUP (ORDER BY at)").alias("kinds"))
    )
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    summed = f"conv_id long, piece long, start long, kinds string, costs array<long>, ranks array<long>, first string, last string, {counts}"
    stretches = written(stretches.mapInArrow(_summaries(costs), summed), "stretches")
    chained = (
        stretches.select("conv_id", "piece", "costs", "ranks", "first", "last").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
        .mapInArrow(_chains(costs), "conv_id long, piece long, begin long, end long, cost long, joint long")
    )
    same = F.col("s.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("s.piece") == F.col("c.piece"))
    joined = stretches.alias("s").join(chained.alias("c"), same).select("s.conv_id", "s.piece", "start", "kinds", "begin", "end", "cost", "joint", *_COUNTS)
    solved = f"conv_id long, piece long, start long, kinds string, begin long, end long, cost long, joint long, {counts}, scripts array<string>"
    scripts = written(joined.mapInArrow(_solved(costs), solved), "scripts")

    gaps = turns.groupBy("conv_id").agg(F.expr("coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0L)").alias("gaps"))
    found = scripts.groupBy("conv_id").agg(
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("joint")).alias("illegal"),
        F.max("cost").alias("cost"),
        F.expr("listagg(array_join(scripts, ''), '') WITHIN GROUP (ORDER BY piece)").alias("audit"),
    )
    conversations = gaps.alias("g").join(found.alias("f"), F.col("g.conv_id").eqNullSafe(F.col("f.conv_id"))).select(
        "g.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    changed = scripts.select("start", "kinds", "begin", "scripts").mapInArrow(_edited, "at long, place long, edit string, role string").where("edit <> 'D'")
    kept = changed.withColumnRenamed("role", "made").join(order.select("at", "row"), "at").join(turns.select("conv_id", "row", "role", "text"), "row")
    repaired = kept.select(
        "conv_id", "at", "place", "edit", F.coalesce("made", "role").alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text")
    )
    return Repair(conversations, repaired)


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) with turns dropped, emptied, cut, repeated or given to the user, by a checksum of conv_id and turn."""
    shown = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")]
    fate = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1])), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.translate(shown[3], ENDS, "")).otherwise(shown[3])
    role = F.when(fate == 4, ROLES["u"]).otherwise(shown[2])
    copies = F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1)))
    return conversations.where(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def transcript_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines role:text of each conversation, hashed one after the other without being held together."""
    lines = turns.select("conv_id", "at", "place", F.concat("role", F.lit(":"), "text").alias("line"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, running = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv_id, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if running is None or conv_id != own:
                    if running is not None:
                        done.append((own, running.hexdigest()))
                    own, running = conv_id, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(line.encode())
            yield _hashes(done)
        yield _hashes([(own, running.hexdigest())] if running is not None else [])

    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "place").drop("at", "place").mapInArrow(hashed, "conv_id long, sha256 string")


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["conv_id", "sha256"])
