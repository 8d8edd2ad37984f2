"""Operator 7: chat formatting with minimum-cost role repair.

A conversation is legal if an optional system turn opens it and user and
assistant turns alternate behind it, the user first. Each turn may be kept,
merged into the turn before it, given another role, or have empty turns put
in front of it; every repair has a cost, and dynamic programming over the
automaton (its states are the role of the last turn) finds the cheapest legal
conversation. The repaired conversation is rendered turn by turn: the
``rendered`` pieces, joined in order of ``position``, are its text.

A turn is a matrix of costs from state to state, and runs of turns multiply
(minimum of sums). Conversations are cut into runs of ``RUN`` turns, runs of
runs and so on; matrices go up the tree and the chosen states come down
again, so the turns of one conversation, however many, are spread over tasks.

Costs, in order of preference on a tie: 0 keep, ``MERGE``, ``RELABEL``
(``UNKNOWN`` where the role is null or none of the three), ``INSERT`` for each
empty turn. A conversation may end with a user or an assistant turn.

Defined results: roles are compared trimmed and in lower case; null text is
empty text; turns are ordered by turn (null last), then role, then text, so
repeated rows follow each other (and merge); rows without conv_id are one
conversation; the template's own markers inside a text are broken up by a
space; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import cut, running_total, ship

ROLES = ("system", "user", "assistant")
#: States: 0 nothing yet, 1..3 the last turn was ROLES[state - 1].
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, UNKNOWN, INSERT = 1, 3, 2, 4
RUN = 512
_FAR = 1 << 40
#: Empty turns needed between a state and the role of the next turn; None where no insertion makes it legal.
_BETWEEN = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,),
    (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}
#: Empty turns behind the last one, by state.
_CLOSING = {START: (USER,), SYSTEM: (USER,), USER: (), ASSISTANT: ()}


def step(role: int, state: int, after: int) -> tuple[int, bool, tuple[int, ...]]:
    """Cheapest way for a turn of ``role`` (0: unknown) to lead from state to state: cost, merged, inserted."""
    own = 0 if role == after else RELABEL if role else UNKNOWN
    merge = own + MERGE if state == after else _FAR
    between = _BETWEEN.get((state, after))
    insert = own + INSERT * len(between) if between is not None else _FAR
    if after == START or min(merge, insert) >= _FAR:
        return _FAR, False, ()
    return (merge, True, ()) if merge <= insert else (insert, False, between)


TURN = np.array([[[step(r, s, t)[0] for t in range(4)] for s in range(4)] for r in range(4)], np.int64)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


def path(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """States after each matrix of the cheapest path from ``first`` to ``last``; ties go to the smaller state."""
    togo = [np.where(np.arange(4) == last, 0, _FAR)]
    for m in reversed(matrices):
        togo.append(np.minimum((m + togo[-1][None, :]).min(axis=1), _FAR))
    togo.reverse()
    states, s = [], first
    for m, rest in zip(matrices, togo[1:]):
        s = int(np.argmin(m[s] + rest))
        states.append(s)
    return states


def _flat(m: np.ndarray) -> list[int]:
    return m.ravel().tolist()


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[dict]]]:
    """Groups of consecutive rows with equal first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(list(row.values())[:keys])
            if rows and k != key:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    schema = pa.schema([("conv", pa.string()), ("run", pa.int64()), ("m", pa.list_(pa.int64()))])
    for (conv, run), rows in _runs(batches, 2):
        total = np.array(rows[0]["m"]).reshape(4, 4)
        for row in rows[1:]:
            total = times(total, np.array(row["m"]).reshape(4, 4))
        out.append({"conv": conv, "run": run, "m": _flat(total)})
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    schema = pa.schema([("conv", pa.string()), ("node", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32())])
    for (conv, _), rows in _runs(batches, 2):
        states = path([np.array(r["m"]).reshape(4, 4) for r in rows], rows[0]["entry"], rows[0]["exit"])
        for row, entry, leave in zip(rows, [rows[0]["entry"], *states], states):
            out.append({"conv": conv, "node": row["node"], "entry": entry, "exit": leave})
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _states(turns: DataFrame) -> DataFrame:
    """(conv, node, entry, exit) of every turn from rows (conv, node, role number)."""
    matrix = F.lit(None).cast("array<bigint>")
    for r in range(4):
        matrix = F.when(F.col("r") == r, F.array(*[F.lit(x).cast("long") for x in _flat(TURN[r])])).otherwise(matrix)
    level = turns.select("conv", "node", matrix.alias("m"))
    levels = []
    # One round per power of RUN in the longest conversation.
    while True:
        levels.append(level)
        most = level.agg(F.max("node")).first()[0]
        if not most:
            break
        level = cut(level.withColumn("run", F.floor(F.col("node") / RUN))
                    .repartition("conv", "run").sortWithinPartitions("conv", "run", "node")
                    .select("conv", "run", "m").mapInArrow(_up, "conv string, run long, m array<bigint>")
                    .withColumnRenamed("run", "node"))
    # Whole conversations: the cheapest legal end (on a tie the earlier state).
    costs = [F.get("m", F.lit(START * 4 + s)) + INSERT * len(_CLOSING[s]) for s in range(4)]
    lowest = F.least(*costs)
    end = F.lit(ASSISTANT)
    for s in reversed(range(4)):
        end = F.when(costs[s] == lowest, F.lit(s)).otherwise(end)
    known = levels[-1].select("conv", "node", F.lit(START).alias("entry"), end.alias("exit"))
    for level in reversed(levels[:-1]):
        known = cut(level.withColumn("run", F.floor(F.col("node") / RUN))
                    .join(known.select(F.col("conv").alias("_c"), F.col("node").alias("_n"), "entry", "exit"),
                          (F.col("conv") == F.col("_c")) & (F.col("run") == F.col("_n")))
                    .repartition("conv", "run").sortWithinPartitions("conv", "run", "node")
                    .select("conv", "run", "node", "m", "entry", "exit")
                    .mapInArrow(_down, "conv string, node long, entry int, exit int"))
    return known


CLOSE = "<|im_end|>\n"


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, position, role_in, role, action, inserted, closing, rendered.

    ``inserted`` and ``closing`` list the empty turns put in front of the turn and behind the last one.
    """
    ship(turns.sparkSession)
    clean = F.lower(F.trim(F.col(role)))
    number = F.lit(0)
    for i, name in enumerate(ROLES, 1):
        number = F.when(clean == name, F.lit(i)).otherwise(number)
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role_in"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"), number.alias("r"))
    rows = rows.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")))
    rows = rows.withColumn("_one", F.lit(1))
    placed = cut(running_total(rows, ["conv"], ["turn", "role_in", "text"], "_one", "position").drop("_one"))
    # The place within the conversation names a turn from here on.
    # The text is left out of all joins that find its turn's role.
    states = _states(placed.select("conv", (F.col("position") - 1).alias("node"), "r"))
    # Cut, so that adaptive execution can split the join at a conversation of very many turns.
    lengths = cut(placed.groupBy("conv").agg(F.max("position").alias("length")).select(F.col("conv").alias("_l"), "length"))
    merged = F.col("entry") == F.col("exit")  # merging is cheaper than any insertion, and nothing leads back to START
    between = F.array().cast("array<string>")
    for (s, t), roles in _BETWEEN.items():
        if roles:
            names = F.array(*[F.lit(ROLES[x - 1]) for x in roles])
            between = F.when((F.col("entry") == s) & (F.col("exit") == t) & ~merged, names).otherwise(between)
    last = F.col("position") == F.col("length")
    closing = F.array().cast("array<string>")
    for s, roles in _CLOSING.items():
        if roles:
            closing = F.when(last & (F.col("exit") == s), F.array(*[F.lit(ROLES[x - 1]) for x in roles])).otherwise(closing)
    new_role = F.get(F.array(*[F.lit(x) for x in ROLES]), F.col("exit") - 1)
    relabelled = F.col("r") != F.col("exit")
    action = F.when(merged & relabelled, "relabel+merge").when(merged, "merge").when(relabelled, "relabel").otherwise("keep")
    safe = F.regexp_replace("text", r"<\|(im_start|im_end)\|>", "<| $1 |>")

    def empties(roles):
        return F.array_join(F.transform(roles, lambda x: F.concat(F.lit("<|im_start|>"), x, F.lit("\n" + CLOSE))), "")

    head = F.when(F.col("action").endswith("merge"), F.lit("\n")).otherwise(
        F.concat(F.when(F.col("position") > 1, F.lit(CLOSE)).otherwise(F.lit("")), empties(F.col("inserted")),
                 F.lit("<|im_start|>"), F.col("role"), F.lit("\n")))
    tail = F.when(last, F.concat(F.lit(CLOSE), empties(F.col("closing")))).otherwise(F.lit(""))
    # All that is known of a turn comes together without its text, which moves once, to meet it.
    known = (states.select(F.col("conv").alias("_c"), "node", "entry", "exit")
             .join(lengths, F.col("_c") == F.col("_l")).drop("_l"))
    joined = (placed.withColumn("_node", F.col("position") - 1)
              .join(known, (F.col("conv") == F.col("_c")) & (F.col("_node") == F.col("node"))))
    return (joined.select("conv_id", "turn", "position", "length", "role_in", new_role.alias("role"), action.alias("action"),
                          between.alias("inserted"), closing.alias("closing"), "text")
            .withColumn("rendered", F.concat(head, safe, tail))
            .select("conv_id", "turn", "position", "role_in", "role", "action", "inserted", "closing", "rendered"))
