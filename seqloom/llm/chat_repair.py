"""Chat formatting with minimum-cost role repair.

Legal conversations are words of an automaton: an optional system turn, then user and
assistant in turn, beginning with user and ending with either. A conversation that isn't legal is repaired at
least cost by dynamic programming over the automaton's states: a turn may be merged into the
one before it (same role), relabelled, or have an empty turn inserted before it. The repaired
conversation is then rendered turn by turn; the rendered pieces of a conversation, joined in
order, are its training text.

One step of the program is a product of small (min, +) matrices, and those products are
associative, so a conversation of any length is worked on in pieces: turns are dealt
out by range of (conversation, turn), each partition reports the matrix of the conversation that it
begins and ends with, the pieces of a conversation that spans partitions are chained (at most two
small matrices a partition reach the driver), and each partition finishes on its own with the states
at its edges given. No conversation has to fit in one task.

Defined cases: null conversation ids form one conversation; null turns come first; turns with equal
numbers follow in order of role and text; null, unknown and misspelt roles are relabelled; null texts are empty;
repeated rows are turns of their own; a conversation of one system turn gets it relabelled; an empty
table gives an empty result; extra columns are ignored. Ties go to the first of: keep, merge, insert.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .common import cut

ROLES = ("system", "user", "assistant")
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "developer": "system", "instruction": "system"}
START, NEVER = 3, 10**9
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 2, 1, 3
#: State (last role, or START) -> roles that may follow.
FOLLOWS = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
ENDS = (1, 2)
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"

SCHEMA = "conv_id long, turn long, role string, new_role string, action string, cost long, rendered string"
ARROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("action", pa.string()), ("cost", pa.int64()), ("rendered", pa.string())])


def code(role: str | None) -> int:
    """0, 1, 2 for the roles, 3 for anything else."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else 3


def step(state: int, role: int, to: int) -> tuple[int, str, int | None]:
    """Cheapest way to take a turn of a role as ``to`` after a state: cost, action, role of an inserted empty turn."""
    change = 0 if role == to else RELABEL_UNKNOWN if role == 3 else RELABEL
    if to in FOLLOWS[state]:
        return change, "keep", None
    if state == to:
        return change + MERGE, "merge", None
    for between in FOLLOWS[state]:
        if to in FOLLOWS[between]:
            return change + INSERT, "insert", between
    return NEVER, "", None


#: MATRICES[role][state, to]
MATRICES = np.array([[[step(s, r, t)[0] for t in range(3)] + [NEVER] for s in range(4)] for r in range(4)], np.int64)


def product(roles: list[int]) -> np.ndarray:
    """Cost from each state to each state over a run of turns."""
    out = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(out, 0)
    for r in roles:
        out = np.minimum((out[:, :, None] + MATRICES[r][None]).min(1), NEVER)
    return out


def best_path(roles: list[int], begin: int, ends: tuple[int, ...]) -> list[int]:
    """Role given to each turn on the cheapest path from a state to one of the end states."""
    n = len(roles)
    cost = np.full((n + 1, 4), NEVER, np.int64)
    cost[n, list(ends)] = 0
    for k in range(n - 1, -1, -1):
        cost[k] = np.minimum((MATRICES[roles[k]] + cost[k + 1][None]).min(1), NEVER)
    path, state = [], begin
    for k, r in enumerate(roles):
        options = [(MATRICES[r][state, t] + cost[k + 1, t], "keep merge insert".split().index(step(state, r, t)[1]) if step(state, r, t)[1] else 9, t) for t in range(3)]
        state = min(options)[2]
        path.append(state)
    return path


def legal(roles: list[int]) -> bool:
    return roles[-1] in ENDS and all(b in FOLLOWS[a] for a, b in pairwise([START, *roles]))


def repair(rows: list[tuple], begin: int = START, ends: tuple[int, ...] = ENDS, closes: bool = True) -> list[tuple]:
    """Output rows of one conversation, or a piece of it; rows: (conv_id, turn, role, text)."""
    roles = [code(r[2]) for r in rows]
    path = roles if begin == START and closes and legal(roles) else best_path(roles, begin, ends)
    out, state = [], begin
    for k, ((conv, turn, role, text), r, to) in enumerate(zip(rows, roles, path, strict=True)):
        cost, action, between = step(state, r, to)
        piece = (text or "").replace("<|im_", "<\\|im_")
        if action == "merge":
            piece = "\n" + piece
        else:
            piece = OPEN.format(ROLES[to]) + piece
            if between is not None:
                piece = OPEN.format(ROLES[between]) + CLOSE + piece
            if state != START:
                piece = CLOSE + piece
        if closes and k == len(rows) - 1:
            piece += CLOSE
        out.append((conv, turn, role, ROLES[to], action if r == to else f"relabel+{action}" if action != "keep" else "relabel", cost, piece))
        state = to
    return out


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one conversation after the other, as they lie in the partition."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def edges(turns: DataFrame) -> list:
    """First and last conversation of each partition, with their matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for rows in conversations(batches):
            last = (rows[0][0], [code(r[2]) for r in rows])
            first = first or last
        found = [] if last is None else [first] if last is first else [first, last]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.int64()), pa.array(range(len(found)), pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([product(f[1]).ravel().tolist() for f in found], pa.list_(pa.int64()))], ["part", "k", "conv_id", "m"])

    return sorted(turns.mapInArrow(run, "part long, k long, conv_id long, m array<long>").collect(), key=lambda r: (r.part, r.k))


def chained(found: list) -> dict[tuple[int, int], tuple[int, tuple[int, ...], bool]]:
    """(partition, 0 first or -1 last) -> (state before, states after, does the conversation end here), for those that span partitions."""
    out: dict[tuple[int, int], tuple[int, tuple[int, ...], bool]] = {}
    parts: dict[int, list] = {}
    for r in found:
        parts.setdefault(r.part, []).append(r)
    chains: list[list] = []
    before = None
    for part in sorted(parts):
        own = parts[part]
        if before is not None and before[-1].conv_id == own[0].conv_id:
            if not chains or chains[-1][-1] is not before[-1]:
                chains.append([before[-1]])
            chains[-1].append(own[0])
        before = own
    for chain in chains:
        ms = [np.array(r.m, np.int64).reshape(4, 4) for r in chain]
        to_go = [np.array([0 if s in ENDS else NEVER for s in range(4)], np.int64)]
        for m in reversed(ms):
            to_go.insert(0, np.minimum((m + to_go[0][None]).min(1), NEVER))
        state = START
        for k, (r, m) in enumerate(zip(chain, ms, strict=True)):
            after = int((m[state] + to_go[k + 1]).argmin())
            out[r.part, 0 if k else -1] = (state, (after,), k == len(chain) - 1)
            state = after
    return out


def repaired(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: its new role, what was done at which cost, and its rendered piece."""
    plain = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    plain = cut(plain.repartitionByRange(*order).sortWithinPartitions(*order))
    spans = chained(edges(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        waiting, k = None, 0

        def done(rows: list[tuple], k: int, last: bool) -> list[tuple]:
            given = spans.get((part, -1)) if last and not ((part, 0) in spans and k == 0) else spans.get((part, 0)) if k == 0 else None
            return repair(rows) if given is None else repair(rows, *given)

        for rows in conversations(batches):
            if waiting is not None:
                out += done(waiting, k, False)
                k += 1
            waiting = rows
            if len(out) >= 2000:
                yield common.batch_of(ARROW, **dict(zip(ARROW.names, zip(*out, strict=True), strict=True)))
                out = []
        if waiting is not None:
            out += done(waiting, k, True)
        yield common.batch_of(ARROW, **dict(zip(ARROW.names, [*zip(*out, strict=True)] or [()] * len(ARROW), strict=True)))

    return plain.mapInArrow(run, SCHEMA)


def op4_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(common.table(spark, sf_dir, "conversations"))
