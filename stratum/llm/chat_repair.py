"""Chat formatting with minimum-cost role repair.

A conversation is legal if an optional system turn stands first, user and
assistant turns alternate from a user turn on, and the last is an assistant turn.
Each given turn is kept, merged into the repaired turn before it (same role after
a relabel, if need be), or opens a turn of its own, relabelled if need be, after
empty turns where the automaton asks for them. Keeping is free; merging,
relabelling and an empty turn have their costs, and dynamic programming over the
automaton's states finds the cheapest repair. The repaired turns are rendered
with a template.

The turns are sorted by conversation and turn over all tasks and cut into chunks
of at most ``CHUNK`` turns, so a conversation of any length is spread over many.
A chunk's least costs from each state to each state are a small matrix; matrices
of the chunks that a conversation runs through are combined by (min, +) products,
which gives the state at every cut, and each chunk then repairs its own part.

Result: one row for each given turn, in order: what became of it (``keep``,
``merge``, ``relabel``, ``relabel+merge``), its role after the repair, the roles
of empty turns that go before it (and, for the last turn, behind it), and the
text it renders to; the concatenation of a conversation's rows is its rendering.

Defined cases: null, empty or unknown roles match no role and are relabelled
always; null texts are empty. Turns with the same number are in the order of a
hash of role and text; null turns come first. A null conv_id is a conversation of its own
(all such rows together). Repeated rows are turns of their own. Other columns are
ignored. Among repairs of the same cost the earlier action in the order above
wins, then the earlier role.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import written

ROLES = ("system", "user", "assistant")
START = 3  # states: the role of the last repaired turn, or START
#: May the second role follow the state?
FOLLOWS = ((0, 1), (1, 2), (2, 1), (START, 0), (START, 1))
LAST = 2
CHUNK = 4096
CHUNK_BYTES = 4 << 20


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    empty: float = 3.0


@dataclass
class Repair:
    """Steps between states at their least cost."""

    costs: Costs = field(default_factory=Costs)

    def __post_init__(self) -> None:
        # empty turns: cheapest ways from state to state by 0, 1, ... empty turns
        self.fill: dict[tuple[int, int], list[int]] = {(s, s): [] for s in range(4)}
        for _ in range(4):
            for (a, b), way in list(self.fill.items()):
                for x, y in FOLLOWS:
                    if x == b and len(way) + 1 < len(self.fill.get((a, y), [0] * 9)):
                        self.fill[a, y] = [*way, y]
        self.moves = {role: self._moves(role) for role in (*range(3), None)}
        self.matrix = {role: self._matrix(m) for role, m in self.moves.items()}

    def _moves(self, role: int | None) -> dict[tuple[int, int], tuple[float, int, list[int]]]:
        """(state, next state) -> (cost, order of the action, empty roles before)."""
        c, best = self.costs, {}
        for s in range(4):
            for to in range(3):
                other = c.relabel if to != role else 0.0
                ways = [(c.merge + other, 2 if not other else 3, [])] if s == to else []
                for x in range(4):  # empty turns lead to x, the turn follows
                    if (x, to) in FOLLOWS and (s, x) in self.fill:
                        way = self.fill[s, x]
                        ways.append((len(way) * c.empty + other, 1 if other else 0, way))
                if ways:
                    best[s, to] = min(ways, key=lambda w: (w[0], w[1], len(w[2])))
        return best

    def _matrix(self, moves: dict) -> np.ndarray:
        m = np.full((4, 4), np.inf)
        for (s, t), (cost, _, _) in moves.items():
            m[s, t] = cost
        return m

    @property
    def end(self) -> np.ndarray:
        """Cost of empty turns from each state to a legal end (none if nothing was said)."""
        return np.array([len(self.fill[s, LAST]) * self.costs.empty if (s, LAST) in self.fill else np.inf for s in range(4)])

    def through(self, roles: list) -> np.ndarray:
        """Least costs from state to state over the turns."""
        total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
        for r in roles:
            total = (total[:, :, None] + self.matrix[r][None]).min(1)
        return total

    def steps(self, roles: list, start: int, end: int) -> list[tuple[int, int, list[int]]]:
        """(state, action, empty roles before) of each turn on the cheapest way."""
        cost, back = np.where(np.arange(4) == start, 0.0, np.inf), []
        for r in roles:
            reach = cost[:, None] + self.matrix[r]
            back.append(reach.argmin(0))
            cost = reach.min(0)
        states = [end]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        states.reverse()
        return [(t, *self.moves[r][s, t][1:]) for r, s, t in zip(roles, states[:-1], states[1:], strict=True)]


ACTIONS = ("keep", "relabel", "merge", "relabel+merge")


def number_of(role: str | None) -> int | None:
    return ROLES.index(role) if role in ROLES else None


@dataclass(frozen=True)
class Template:
    """A repaired turn renders to head, texts with joints between, tail."""

    head: str = "<|{role}|>\n"
    joint: str = "\n"
    tail: str = "\n"

    def empty(self, roles: list[int]) -> str:
        return "".join(self.head.format(role=ROLES[r]) + self.tail for r in roles)


_CHUNK = ("chunk long, convs array<{id}>, turns array<{turn}>, roles array<string>, texts array<string>")


def _chunks(turns: DataFrame) -> DataFrame:
    """Rows of up to CHUNK turns in order; a conversation may run through several."""
    id_type, turn_type = dict(turns.dtypes)["conv_id"], dict(turns.dtypes)["turn"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", F.xxhash64("role", "text")]
    ordered = turns.select("conv_id", "turn", "role", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order, "role", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        nth, held, size = TaskContext.get().partitionId() << 32, [], 0

        def made() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array([nth], pa.int64())] + [
                pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column(i).combine_chunks().cast(
                    pa.string() if i > 1 else t.schema.field(i).type)) for i in range(4)],
                ["chunk", "convs", "turns", "roles", "texts"])

        for batch in batches:
            at = 0
            while at < len(batch):
                n = min(CHUNK - size, len(batch) - at)
                piece = batch.slice(at, n)
                while n > 1 and piece.nbytes > CHUNK_BYTES:
                    n //= 2
                    piece = batch.slice(at, n)
                held.append(piece)
                size += n
                at += n
                if size >= CHUNK or sum(p.nbytes for p in held) >= CHUNK_BYTES:
                    yield made()
                    nth, held, size = nth + 1, [], 0
        if held:
            yield made()

    return ordered.mapInArrow(cut, _CHUNK.format(id=id_type, turn=turn_type))


def _runs(convs: list) -> list[tuple[int, int]]:
    """Where each conversation's turns begin and end in a chunk."""
    cuts = [0] + [i for i in range(1, len(convs)) if convs[i] != convs[i - 1]] + [len(convs)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def repair(turns: DataFrame, costs: Costs = Costs(), template: Template = Template()) -> DataFrame:
    """(conv_id, turn, nth, action, role, empty_before, empty_after, rendered,
    cost) of each given turn (conv_id, turn, role, text)."""
    from pyspark.sql import Window

    chunks = written(_chunks(turns), "chat-chunks")
    id_type = chunks.schema["convs"].dataType.elementType
    turn_type = chunks.schema["turns"].dataType.elementType
    part_type = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("conv_id", id_type), T.StructField("n", T.LongType()),
        T.StructField("cost", T.ArrayType(T.DoubleType()))])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the conversations at a chunk's edges: the matrix of costs."""
        from pyspark.sql.pandas.types import to_arrow_schema

        way, schema = Repair(costs), to_arrow_schema(part_type)
        for batch in batches:
            for row in batch.to_pylist():
                runs = _runs(row["convs"])
                for lo, hi in {runs[0], runs[-1]}:
                    roles = [number_of(r) for r in row["roles"][lo:hi]]
                    yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "conv_id": row["convs"][lo], "n": hi - lo,
                                                       "cost": way.through(roles).reshape(-1).tolist()}], schema)

    # conversations that run over a cut: one row of 16 numbers a chunk
    edges = written(chunks.select("chunk", "convs", "roles").mapInArrow(parts, part_type), "chat-edges")
    cut = edges.withColumn("many", F.count("*").over(Window.partitionBy("conv_id"))).where("many > 1").drop("many")
    state_type = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("conv_id", id_type), T.StructField("before", T.LongType()),
                               T.StructField("enter", T.IntegerType()), T.StructField("leave", T.IntegerType()), T.StructField("is_last", T.BooleanType())])

    def states(pdf):
        import pandas as pd

        pdf = pdf.sort_values("chunk")
        way, ms = Repair(costs), [np.array(c).reshape(4, 4) for c in pdf["cost"]]
        cost, back = np.where(np.arange(4) == START, 0.0, np.inf), []
        for m in ms:
            reach = cost[:, None] + m
            back.append(reach.argmin(0))
            cost = reach.min(0)
        at = [int((cost + way.end).argmin())]
        for b in reversed(back):
            at.append(int(b[at[-1]]))
        at.reverse()
        n = pdf["n"].to_numpy()
        return pd.DataFrame({"chunk": pdf["chunk"], "conv_id": pdf["conv_id"], "before": np.cumsum(n) - n, "enter": at[:-1], "leave": at[1:],
                             "is_last": [False] * (len(pdf) - 1) + [True]})

    # a chunk has two cuts at most, so the array holds two entries at most
    known = (cut.groupBy("conv_id").applyInPandas(states, state_type).groupBy("chunk")
             .agg(F.collect_list(F.struct("conv_id", "before", "enter", "leave", "is_last")).alias("cuts")))
    out_type = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("turn", turn_type), T.StructField("nth", T.LongType()),
        T.StructField("action", T.StringType()), T.StructField("role", T.StringType()),
        T.StructField("empty_before", T.ArrayType(T.StringType())), T.StructField("empty_after", T.ArrayType(T.StringType())),
        T.StructField("rendered", T.StringType()), T.StructField("cost", T.DoubleType())])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        way, schema = Repair(costs), to_arrow_schema(out_type)
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                cuts = row["cuts"] or []
                for lo, hi in _runs(row["convs"]):
                    roles = [number_of(r) for r in row["roles"][lo:hi]]
                    conv = row["convs"][lo]
                    known = next((c for c in cuts if c["conv_id"] == conv), None)
                    if known:
                        before, enter, leave, last = known["before"], known["enter"], known["leave"], known["is_last"]
                    else:
                        before, enter, last = 0, START, True
                        leave = int((way.through(roles)[START] + way.end).argmin())
                    state = enter
                    for i, (to, action, empty) in enumerate(way.steps(roles, enter, leave)):
                        text = row["texts"][lo + i] or ""
                        end = way.fill[leave, LAST] if last and lo + i == hi - 1 else []
                        if action > 1:
                            text = template.joint + text
                        else:  # a turn that opens closes the one before
                            text = (template.tail if before + i else "") + template.empty(empty) + template.head.format(role=ROLES[to]) + text
                        if last and lo + i == hi - 1:
                            text += template.tail + template.empty(end)
                        out.append({
                            "conv_id": conv, "turn": row["turns"][lo + i], "nth": before + i, "action": ACTIONS[action], "role": ROLES[to],
                            "empty_before": [ROLES[e] for e in empty], "empty_after": [ROLES[e] for e in end],
                            "rendered": text,
                            "cost": way.moves[roles[i]][state, to][0] + len(end) * costs.empty})
                        state = to
                yield pa.RecordBatch.from_pylist(out, schema)

    return chunks.join(known, "chunk", "left").mapInArrow(repaired, out_type)


def op9_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations, repaired and rendered."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
