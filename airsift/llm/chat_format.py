"""Chat formatting: conversations repaired to legal turns at least cost, then rendered.

A legal conversation is an optional system turn, then user and assistant in turn, ending with assistant. Each given
turn may stay, be relabelled to another role, be merged into the turn before it, or get an empty turn inserted before
it; an empty answer may be added at the end. Each has a price; dynamic programming over the automaton of legal turns
finds a cheapest repair. Of equally cheap ones the one is taken whose choices, from the first turn on, come first in the
order of ``CHOICES``.

A conversation may be of any length. Turns are sorted and cut into parts; a conversation can run over many parts. The
cost of a run of turns is a small matrix (state before, state after), and matrices of consecutive runs combine by
(min, +). So each part is summed up by the matrices of the conversations at its two edges, the driver combines those
(two small matrices a part), and a second pass over the parts repairs every turn knowing the state before and the
costs after. No task holds more than a part of a conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.session import shared_folder

# Turns of a part and bytes of their texts, about: parts are cut finer than the session's shuffles where the table needs it.
PART_TURNS = 200_000
PART_BYTES = 128 << 20
# Characters of a text that are its key where parts are cut: a sample of the keys goes to the driver.
KEY_CHARACTERS = 64

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = ("", "system", "user", "assistant")
MERGE, RELABEL, INSERT = 1.0, 2.0, 3.0
END = "<|end|>"

_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# What may be inserted between a state and a role that cannot follow it at once.
_BRIDGE = {(START, ASSISTANT): USER, (SYSTEM, ASSISTANT): USER, (USER, USER): ASSISTANT, (ASSISTANT, ASSISTANT): USER}
# (state before, role taken, way): a stay or relabel where legal, a merge into the same role, an insertion before.
CHOICES = tuple(
    choice
    for state in range(4)
    for choice in (
        *((state, role, "append") for role in _NEXT[state]),
        *(((state, state, "merge"),) if state else ()),
        *((state, role, "insert") for role in (USER, ASSISTANT) if (state, role) in _BRIDGE),
    )
)
_PRICES = {"append": 0.0, "merge": MERGE, "insert": INSERT}
# Cost of closing a conversation that stands in a state, and the empty turns added.
_CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
FINAL = np.array([INSERT * len(_CLOSING[state]) for state in range(4)])

# Price of each choice for each given role (0: not a known role).
_COST = np.array([[_PRICES[way] + RELABEL * (role != given) for _, role, way in CHOICES] for given in range(4)])
_FROM, _TO = (np.array([choice[k] for choice in CHOICES]) for k in (0, 1))
_STEP = np.full((4, 4, 4), np.inf)
for _given in range(4):
    np.minimum.at(_STEP[_given], (_FROM, _TO), _COST[_given])


def _codes(roles: pa.Array) -> np.ndarray:
    names = pd.Series(roles.to_pylist(), dtype=object)
    return names.map({name: code for code, name in enumerate(STATES) if code}).fillna(0).to_numpy(dtype=np.int64)


def run_matrix(roles: np.ndarray) -> np.ndarray:
    """Cheapest cost from each state before the turns to each state after them."""
    costs = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for role in roles:
        costs = (costs[:, :, None] + _STEP[role][None]).min(axis=1)
    return costs


def choose(roles: np.ndarray, before: int, after: np.ndarray) -> np.ndarray:
    """The place in ``CHOICES`` for each turn, from state ``before``, if ending in a state costs ``after``."""
    ahead = np.empty((len(roles) + 1, 4))
    ahead[-1] = after
    for turn in range(len(roles) - 1, -1, -1):
        ahead[turn] = (_STEP[roles[turn]] + ahead[turn + 1]).min(axis=1)
    out = np.empty(len(roles), dtype=np.int64)
    for turn, role in enumerate(roles):
        total = np.where(_FROM == before, _COST[role] + ahead[turn + 1][_TO], np.inf)
        out[turn] = int(total.argmin())
        before = int(_TO[out[turn]])
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
    """Conversation and known roles of each run of turns in a part, as they come; a run may come in several pieces."""
    for batch in batches:
        convs = batch.column(0).to_numpy(zero_copy_only=False)
        roles = _codes(batch.column(1))
        same = (convs[1:] == convs[:-1]) | (pd.isna(convs[1:]) & pd.isna(convs[:-1]))
        cuts = np.append(0, np.flatnonzero(~same) + 1)
        for first, last in zip(cuts, np.append(cuts[1:], len(convs))):
            yield (None if pd.isna(convs[first]) else int(convs[first])), roles[first:last]


def _add(matrix: np.ndarray, more: np.ndarray) -> np.ndarray:
    return (matrix[:, :, None] + more[None]).min(axis=1)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a part: its number, and conversation and matrix of its first and its last run."""
    first = last = None
    runs = 0
    for conv, roles in _runs(batches):
        if last is not None and last[0] == conv:
            last = (conv, _add(last[1], run_matrix(roles)))
        else:
            if runs == 1:
                first = last
            last = (conv, run_matrix(roles))
            runs += 1
    if last is None:
        return
    first = last if runs == 1 else first
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([TaskContext.get().partitionId()]),
            pa.array([runs]),
            pa.array([first[0]], pa.int64()),
            pa.array([last[0]], pa.int64()),
            pa.array([first[1].ravel().tolist()]),
            pa.array([last[1].ravel().tolist()]),
        ],
        names=["part", "runs", "first_conv", "last_conv", "first_costs", "last_costs"],
    )


def _after(edges: list) -> list[np.ndarray]:
    """For each part, in order: the cost of what follows its last turn, by state."""
    out = [FINAL] * len(edges)
    for place in range(len(edges) - 2, -1, -1):
        here, following = edges[place], edges[place + 1]
        if here["last_conv"] == following["first_conv"]:
            # If the next part is all one conversation, more may follow; else its first run ends it.
            rest = out[place + 1] if following["runs"] == 1 else FINAL
            out[place] = (np.array(following["first_costs"]).reshape(4, 4) + rest).min(axis=1)
    return out


def _exits(after: dict[int, np.ndarray]):
    """For each part, the state after its last run for each state before that run."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, pieces, runs = TaskContext.get().partitionId(), None, [], 0
        for name, roles in _runs(batches):
            if not runs or name != conv:
                conv, pieces, runs = name, [], runs + 1
            pieces.append(roles)
        if runs:
            roles = np.concatenate(pieces)
            ends = [int(_TO[choose(roles, state, after[part])[-1]]) for state in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([ends], pa.list_(pa.int64()))], names=["part", "ends"])

    return rows


def _repaired(before: dict[int, int], after: dict[int, np.ndarray], continues: dict[int, bool]):
    schema_names = ["conv_id", "turn", "role", "repaired_role", "action", "cost", "rendered"]

    def written(rows: pa.Table, state: int, rest: np.ndarray, ends: bool) -> pa.RecordBatch:
        given = rows.column("role").to_pylist()
        roles = _codes(rows.column("role"))
        taken = choose(roles, state, rest)
        out: dict[str, list] = {"role": [], "action": [], "cost": [], "rendered": []}
        for place, (choice, text) in enumerate(zip(taken, rows.column("text"))):
            state, role, way = CHOICES[choice]
            text = text.as_py() or ""
            close = "" if state == START else f"{END}\n"
            head = f"<|{STATES[role]}|>\n"
            if way == "merge":
                piece = "\n" + text
            elif way == "insert":
                piece = f"{close}<|{STATES[_BRIDGE[state, role]]}|>\n{END}\n{head}{text}"
            else:
                piece = f"{close}{head}{text}"
            actions = [*(["insert " + STATES[_BRIDGE[state, role]]] if way == "insert" else []), *(["merge"] if way == "merge" else []), *(["relabel"] if given[place] != STATES[role] else [])]
            cost = float(_COST[roles[place], choice])
            if ends and place == len(taken) - 1:
                added = _CLOSING[role]
                piece += f"{END}\n" + "".join(f"<|{STATES[a]}|>\n{END}\n" for a in added)
                actions += ["add " + STATES[a] for a in added]
                cost += INSERT * len(added)
            out["role"].append(STATES[role])
            out["action"].append(", ".join(actions) or "keep")
            out["cost"].append(cost)
            out["rendered"].append(piece)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("conv_id").combine_chunks(), rows.column("turn").combine_chunks(), rows.column("role").combine_chunks(),
                pa.array(out["role"], pa.string()), pa.array(out["action"], pa.string()), pa.array(out["cost"], pa.float64()), pa.array(out["rendered"], pa.string()),
            ],
            names=schema_names,
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pieces: list[pa.RecordBatch] = []
        state, conv, begun = before.get(part, START), None, False
        for batch in batches:
            convs = batch.column(0).to_numpy(zero_copy_only=False)
            same = (convs[1:] == convs[:-1]) | (pd.isna(convs[1:]) & pd.isna(convs[:-1]))
            cuts = np.append(0, np.flatnonzero(~same) + 1)
            for first, last in zip(cuts, np.append(cuts[1:], len(convs))):
                name = None if pd.isna(convs[first]) else int(convs[first])
                if begun and name != conv:
                    yield written(pa.Table.from_batches(pieces), state, FINAL, True)
                    state, pieces = START, []
                pieces.append(batch.slice(first, last - first))
                conv, begun = name, True
        if begun:
            yield written(pa.Table.from_batches(pieces), state, after[part], not continues[part])

    return rows


def _parts(table: DataFrame) -> int:
    """The parts that a table needs, by its turns and the bytes of their texts."""
    size = table.agg(F.count("*").alias("turns"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size["turns"] // PART_TURNS), -(-size["bytes"] // PART_BYTES))


def repair(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per given turn: conv_id, turn, role, repaired_role, action, cost and rendered.

    ``rendered`` strings of a conversation, joined in order of turn, are the repaired conversation as text. Turns are
    ordered by turn (nulls first), then role, the first ``KEY_CHARACTERS`` characters of the text and a 64-bit hash of all
    of it, so ties and repeated rows have one order; their rows are all kept. Equal rows may lie in several parts. Unknown
    and null roles are relabelled, null texts are empty. Turns without conv_id are one conversation. An empty table gives
    no rows. ``parts`` is the number of parts, by default that of the session's shuffles, or more where the parts would
    have over ``PART_TURNS`` turns or ``PART_BYTES`` of text on average.
    """
    spark = conversations.sparkSession
    table = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    count = parts or _parts(table)
    order = ["conv_id", "turn", "role", F.substring("text", 1, KEY_CHARACTERS), F.xxhash64("text")]
    # The parts must be the same in each pass, whatever is lost and run again.
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoint"))
    placed = table.repartitionByRange(count, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "text").checkpoint()
    schema = "part long, runs long, first_conv long, last_conv long, first_costs array<double>, last_costs array<double>"
    edges = sorted(placed.select("conv_id", "role").mapInArrow(_edges, schema).collect(), key=lambda row: row["part"])
    rests = _after(edges)
    after = {row["part"]: rest for row, rest in zip(edges, rests)}
    continues = {row["part"]: place + 1 < len(edges) and row["last_conv"] == edges[place + 1]["first_conv"] for place, row in enumerate(edges)}
    ends = {row["part"]: row["ends"] for row in placed.select("conv_id", "role").mapInArrow(_exits(after), "part long, ends array<long>").collect()}
    before: dict[int, int] = {}
    for place, row in enumerate(edges[:-1]):
        if continues[row["part"]]:
            # The last run begins in this part, unless the part is one run that came in from the part before.
            came = before.get(row["part"], START) if row["runs"] == 1 else START
            before[edges[place + 1]["part"]] = ends[row["part"]][came]
    schema = "conv_id long, turn long, role string, repaired_role string, action string, cost double, rendered string"
    return placed.mapInArrow(_repaired(before, after, continues), schema)
