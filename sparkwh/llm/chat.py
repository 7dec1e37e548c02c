"""Chat formatting with minimum-cost role repair.

The legal turn sequences are those of a small automaton: an optional system turn, then user and assistant in alternation.
Dynamic programming over its states finds the cheapest repair of a conversation: joining a turn to the one before, giving it
another role, or inserting an empty turn of the missing role. The repaired sequence is rendered turn by turn.

A conversation of any length is repaired exactly without gathering it in one task: it is cut into chunks of turns, every
chunk becomes a table of the cheapest cost from each state to each state, only these tables (one row per chunk) are chained
per conversation, and each chunk is then solved between the states found for it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.numbering import range_sorted
from ..session import stage
from .batches import grouped, tidy

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
# Other names in use for the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "bot": ASSISTANT,
           "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "chatgpt": ASSISTANT}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_OPEN, _CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"
_FAR = 1 << 40
_NONE = -(1 << 63)  # stands for a NULL conv_id, and for the chunk of NULL turn numbers


@dataclass(frozen=True)
class RepairCosts:
    """Costs of the repairs. An unknown role is given one at ``unknown``. Of equally cheap repairs the one with the earlier
    kept, then merged, then inserted turn is taken. ``chunk`` turns are solved at a time."""
    merge: int = 2
    insert: int = 3
    relabel: int = 4
    unknown: int = 1
    chunk: int = 512


def steps(costs: RepairCosts) -> list[list[list[tuple[int, int, int, int, str]]]]:
    """For every role (0: unknown) and state: (next state, cost, inserted role or 0, whether merged, action), cheapest first."""
    table = []
    for role in range(4):
        per_state = []
        for state in range(4):
            found = []
            for target in (SYSTEM, USER, ASSISTANT):
                base = 0 if target == role else costs.unknown if role == 0 else costs.relabel
                name = "keep" if target == role else "relabel"
                if target in NEXT[state]:
                    found.append((target, base, 0, 0, name))
                if target == state:
                    found.append((target, base + costs.merge, 0, 1, "merge" if name == "keep" else "relabel+merge"))
                for between in NEXT[state]:
                    if target in NEXT[between]:
                        found.append((target, base + costs.insert, between, 0, "insert" if name == "keep" else "relabel+insert"))
            per_state.append(sorted(found, key=lambda x: (x[1], x[3], x[2], x[0])))
        table.append(per_state)
    return table


def cost_table(roles: list[int], table) -> np.ndarray:
    """Cheapest cost of the turns from every state (row) to every state."""
    best = np.full((4, 4), _FAR, np.int64)
    np.fill_diagonal(best, 0)
    moves = [np.full((4, 4), _FAR, np.int64) for _ in range(4)]
    for role in range(4):
        for state in range(4):
            for target, cost, *_ in table[role][state]:
                moves[role][state, target] = min(moves[role][state, target], cost)
    for role in roles:
        best = np.minimum((best[:, :, None] + moves[role][None]).min(1), _FAR)
    return best


def solve(roles: list[int], begin: int, end: int, table) -> list[tuple]:
    """The cheapest steps that lead from state ``begin`` to state ``end``."""
    cost, back = {begin: 0}, []
    for role in roles:
        new, came = {}, {}
        for state in sorted(cost):
            for step in table[role][state]:
                total = cost[state] + step[1]
                if step[0] not in new or total < new[step[0]]:
                    new[step[0]], came[step[0]] = total, (state, step)
        cost = new
        back.append(came)
    out, state = [], end
    for came in reversed(back):
        before, step = came[state]
        out.append((before, step))
        state = before
    return out[::-1]


def _keys(group: pa.Table, rows: int) -> list[pa.Array]:
    """The first columns of the first ``rows`` rows: conv, chunk, part."""
    return [group.column(k).slice(0, rows).combine_chunks() for k in range(3)]


def _tables(costs: RepairCosts):
    table = steps(costs)

    def run(batches):
        for group in grouped(batches, 3):
            best = cost_table(group.column(3).to_pylist(), table)
            yield pa.RecordBatch.from_arrays([*_keys(group, 1), pa.array([best.ravel().tolist()], pa.list_(pa.int64()))],
                                             names=["conv", "chunk", "part", "best"])
    return run


def _chain(batches):
    """Entry and exit state of every chunk, and whether it is the last, of (conv, chunk, part, best) in that order."""
    for group in grouped(batches, 1):
        cost, back = np.array([0, _FAR, _FAR, _FAR]), []
        for flat in group.column(3).to_pylist():
            total = cost[:, None] + np.array(flat, np.int64).reshape(4, 4)
            back.append(total.argmin(0))
            cost = np.minimum(total.min(0), _FAR)
        ends, ahead = np.zeros((len(back), 2), np.int32), int(cost.argmin())
        for k in range(len(back) - 1, -1, -1):
            ends[k] = back[k][ahead], ahead
            ahead = int(back[k][ahead])
        yield pa.RecordBatch.from_arrays(
            [*_keys(group, group.num_rows), pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy()),
             pa.array(np.arange(len(back)) == len(back) - 1)], names=["conv", "chunk", "part", "begin", "end", "last"])


def _escaped(text: str | None) -> str:
    """A text cannot open or close a turn."""
    return (text or "").replace("<|im_", "< |im_")


def _rendered(costs: RepairCosts):
    table = steps(costs)

    def run(batches):
        for group in grouped(batches, 3):
            turns, original, roles, texts, begin, end, last = (c.to_pylist() for c in group.columns[3:])
            out = []
            solved = solve(roles, begin[0], end[0], table)
            for k, (before, (target, cost, inserted, merged, action)) in enumerate(solved):
                piece = ""
                if inserted:
                    piece += (_CLOSE if before else "") + _OPEN.format(ROLES[inserted])
                    before = inserted
                piece += "\n" if merged else (_CLOSE if before else "") + _OPEN.format(ROLES[target])
                piece += _escaped(texts[k])
                if last[0] and k == len(solved) - 1:
                    piece += _CLOSE
                out.append((turns[k], original[k], ROLES[target], action, cost, (not merged) + bool(inserted), piece))
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [_keys(group, group.num_rows)[0], *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["conv", "turn", "role", "new_role", "action", "cost", "new_turns", "rendered"])
    return run


def repaired(conversations: DataFrame, costs: RepairCosts = RepairCosts()) -> DataFrame:
    """One row per turn: ``conv_id, turn, role, new_role, action, cost, new_turns, rendered``.

    The ``rendered`` pieces of a conversation in order of turns, one after another, are its formatted text. ``action`` is
    keep, merge, insert, relabel, relabel+merge or relabel+insert; ``new_turns`` counts the turns the row opens. Roles are
    read without regard to case and surrounding spaces; NULL and unknown ones fit any role at a small cost. NULL texts are
    empty. Rows with the same turn number, repeated rows too, are all kept, ordered by role, then text; NULL numbers come first.
    Rows with NULL ``conv_id`` are one conversation. Other columns are ignored; an empty table gives no rows.
    """
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    role = F.lower(F.trim(F.col("role").cast("string")))
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NONE)).alias("conv"),
        F.coalesce(F.floor(F.col("turn").cast("long") / costs.chunk), F.lit(_NONE)).cast("long").alias("chunk"),
        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(known[role], F.lit(0)).cast("int").alias("code"), F.col("text").cast("string").alias("text"))
    # Where very many rows share turn numbers, their chunk is cut again along the order of its rows.
    crowded = stage(turns.groupBy("conv", "chunk").count().where(F.col("count") > 8 * costs.chunk).select("conv", "chunk"), "crowded")
    if crowded.isEmpty():
        placed = turns.withColumn("part", F.lit(0).cast("long"))
    else:
        cut = range_sorted(turns.join(crowded, ["conv", "chunk"], "left_semi"), ["conv", "chunk", "turn", "code", "role", "text"])
        part = F.floor((F.shiftleft("_part", 33) + F.col("_row")) / costs.chunk)
        placed = stage(turns.join(crowded, ["conv", "chunk"], "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(
            cut.withColumn("part", part.cast("long")).select(*turns.columns, "part")), "turns")
    key, order = ["conv", "chunk", "part"], ["turn", "code", "role", "text"]
    tables = (placed.select(*key, "code", *[c for c in order if c != "code"]).repartition(*key).sortWithinPartitions(*key, *order)
              .select(*key, "code").mapInArrow(tidy(_tables(costs)), "conv long, chunk long, part long, best array<long>"))
    chained = stage(tables.repartition("conv").sortWithinPartitions(*key)
                    .mapInArrow(tidy(_chain), "conv long, chunk long, part long, begin int, end int, last boolean"), "chained")
    solved = (placed.join(chained, key).repartition(*key).sortWithinPartitions(*key, *order)
              .select(*key, "turn", "role", "code", "text", "begin", "end", "last")
              .mapInArrow(tidy(_rendered(costs)), "conv long, turn long, role string, new_role string, action string, cost long, "
                                            "new_turns long, rendered string"))
    return solved.select(F.when(F.col("conv") != _NONE, F.col("conv")).alias("conv_id"), "turn", "role", "new_role", "action", "cost",
                         "new_turns", "rendered")
