"""Chat formatting: a finite-state machine over roles and a declarative template.

The template lists, per role, the segments of a turn: literals and fields, each
with its loss flag.  The machine lists which role may follow in which state.
Both are data; nothing in the code names a role.

Turns are ordered in ranges of (conversation, turn), which cut through long
conversations, so formatting is spread however long one of them is.  A range
does not know the state in which its first conversation arrives.  It therefore
runs that conversation from every state at once: what a run of turns does to the
machine is a map from states to states, and the maps of the ranges, one row
each, are composed afterwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.common import tasks_of
from stockloom.session import materialise

ROLE, TEXT = "role", "text"


@dataclass(frozen=True)
class Segment:
    """A literal, or a field of the turn (``ROLE`` or ``TEXT``), and its loss flag."""

    literal: str = ""
    field: str | None = None
    loss: bool = False


def _turn(loss: bool) -> tuple[Segment, ...]:
    return (Segment("<|im_start|>"), Segment(field=ROLE), Segment("\n"), Segment(field=TEXT, loss=loss), Segment("<|im_end|>\n"))


@dataclass(frozen=True)
class Template:
    """Segments by role, and those of any other role.

    A turn's segments must begin with ``start``, hold the role up to a line
    feed, the text, and end with ``end``, so that the output can be read back.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    roles: dict[str, tuple[Segment, ...]] = field(default_factory=lambda: {"assistant": _turn(True)})
    other: tuple[Segment, ...] = field(default_factory=lambda: _turn(False))


@dataclass(frozen=True)
class Machine:
    """Allowed moves (state, role) -> state; every other move ends in ``error``, for good."""

    first: str = "start"
    error: str = "error"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
        ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant"})
    #: States in which a conversation is complete.
    last: tuple[str, ...] = ("assistant",)

    @property
    def states(self) -> list[str]:
        return sorted({self.first, self.error, *self.last, *(s for s, _ in self.moves), *self.moves.values()})

    def step(self, state: str, role: str) -> str:
        return self.moves.get((state, role), self.error)


_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string begins in the result: ``<|`` becomes ``<\\|``, and where
    backslashes stand between the two characters, one more does."""
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """A role on one line: as a text, and with line feeds written ``\\n``."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def format_turn(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """The segments of a turn: (string, loss flag)."""
    values = {ROLE: escape_role(role), TEXT: escape(text)}
    return [(values[s.field] if s.field else s.literal, s.loss) for s in template.roles.get(role, template.other)]


def read_turn(template: Template, formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; raises if it isn't one whole turn."""
    inner = formatted[len(template.start):len(formatted) - len(template.end)]
    if not (formatted.startswith(template.start) and formatted.endswith(template.end)) or "\n" not in inner or "<|" in inner:
        raise ValueError("not a formatted turn")
    role, text = inner.split("\n", 1)
    return unescape_role(role), unescape(text)


def _formatter(template: Template, machine: Machine):
    """Formats one range of turns in order; state maps as the module says."""
    states = machine.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, leading, conv = 0, True, None
        now: tuple[str, ...] = ()
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("place", "formatted", "lengths", "losses", "after")}
            for i, role, text in zip(b.column("conv").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
                if place == 0:
                    now = tuple(states)
                elif i != conv:
                    leading, now = False, (machine.first,) * len(states)
                conv = i
                now = tuple(machine.step(s, role) for s in now) if leading else (machine.step(now[0], role),) * len(states)
                segments = format_turn(template, role, text)
                out["place"].append(place)
                out["formatted"].append("".join(s for s, _ in segments))
                out["lengths"].append([len(s) for s, _ in segments])
                out["losses"].append([x for _, x in segments])
                out["after"].append([states.index(s) for s in now])
                place += 1
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), pa.array(out["place"], pa.int64()), pa.array(out["formatted"], pa.string()),
                 pa.array(out["lengths"], pa.list_(pa.int32())), pa.array(out["losses"], pa.list_(pa.bool_())),
                 pa.array(out["after"], pa.list_(pa.int32()))], ["conv", "place", "formatted", "lengths", "losses", "after"])

    return run


def format_conversations(df: DataFrame, template: Template | None = None, machine: Machine | None = None, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted turns as a written stage: part, place, conv, formatted,
    lengths and losses (of the segments), state (of the machine after the turn).

    (part, place) is the order of all turns: by conversation, turn, and for ties
    role, text and a running number; nulls first.  A null text or role is empty, an
    unknown or misplaced role leaves the machine in its error state, and the turn
    is formatted all the same.  Other columns are ignored.
    """
    template, machine = template or Template(), machine or Machine()
    states = machine.states
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text_key", "copy"]
    keyed = rows.withColumn("text_key", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    kind = df.schema[conv_col].dataType.simpleString()
    ordered = keyed.repartitionByRange(tasks_of(df), *order).sortWithinPartitions(*order).select("conv", "role", "text")
    made = ordered.mapInArrow(_formatter(template, machine), f"conv {kind}, place long, formatted string, lengths array<int>, losses array<boolean>, after array<int>")
    turns = materialise(made.withColumn("part", F.spark_partition_id()), "chat-turns")

    # One row per range: the conversation it begins and ends with, and its map of states.
    edge = F.struct("place", "conv", "after")
    parts = turns.groupBy("part").agg(F.min_by("conv", "place").alias("first"), F.max(edge).alias("end")) \
        .select("part", "first", F.col("end.conv").alias("conv"), F.col("end.after").alias("after"))
    over = Window.orderBy("part")
    joined = parts.withColumn("goes_on", (F.col("part") > F.min("part").over(over)) & F.lag("conv").over(over).eqNullSafe(F.col("first")))
    steps = F.collect_list(F.struct("part", "goes_on", "after")).over(over.rowsBetween(Window.unboundedPreceding, -1))
    begin = F.lit(states.index(machine.first))
    zero = F.struct(begin.alias("arrive"), begin.alias("leave"))

    def chain(state, s):
        arrive = F.when(s["goes_on"], state["leave"]).otherwise(begin)
        return F.struct(arrive.alias("arrive"), F.get(s["after"], arrive).alias("leave"))

    folded = F.aggregate(steps, zero, chain)
    starts = joined.select("part", F.when(F.col("goes_on"), folded["leave"]).otherwise(begin).alias("arrive"))
    named = F.array(*[F.lit(s) for s in states])
    return (turns.join(F.broadcast(starts), "part")  # one row per range
            .select("part", "place", "conv", "formatted", "lengths", "losses",
                    F.get(named, F.get("after", F.col("arrive"))).alias("state")))


def _digests(template: Template):
    """Reads the turns of each conversation back, in order, keeping two running
    digests and three sums of the one at hand."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        n = loss_chars = chars = 0
        turns = loss = None
        for b in batches:
            done = []
            for conv, formatted, lengths, losses in zip(*(b.column(c).to_pylist() for c in ("conv", "formatted", "lengths", "losses"))):
                if at != (conv,):
                    if at:
                        done.append((*at, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    at, n, loss_chars, chars, turns, loss = (conv,), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, text = read_turn(template, formatted)
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                offset = 0
                for length, flag in zip(lengths, losses):
                    if flag:
                        learned = unescape(formatted[offset:offset + length])
                        loss.update(learned.encode("utf-8", "surrogatepass"))
                        loss_chars += len(learned)
                    offset += length
                n, chars = n + 1, chars + len(formatted)
            yield from _rows(done, b.schema.field("conv").type)
        if at:
            yield from _rows([(*at, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)], b.schema.field("conv").type)

    def _rows(done: list[tuple], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if done:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return run


def conversation_report(turns: DataFrame, template: Template | None = None, machine: Machine | None = None, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read back from ``format_conversations``: id,
    n_turns, turns_sha256 (of role, line feed, text, line feed per turn),
    loss_chars and loss_sha256 (of the text under the loss mask, unescaped),
    formatted_chars, valid (every move was allowed), complete (and the last
    state is a final one).

    A digest is one chain, so a conversation's turns pass through one task; they
    stream, only running digests are kept.
    """
    template, machine = template or Template(), machine or Machine()
    kind = turns.schema["conv"].dataType.simpleString()
    streams = (turns.select("conv", "part", "place", "formatted", "lengths", "losses").repartition(tasks_of(turns), "conv")
               .sortWithinPartitions("conv", "part", "place").select("conv", "formatted", "lengths", "losses"))
    digests = streams.mapInArrow(_digests(template), f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    ends = turns.groupBy(F.col("conv").alias("_conv")).agg(F.max_by("state", F.struct("part", "place")).alias("state"))
    return digests.join(ends, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        F.col("conv").alias(conv_col), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
        (F.col("state") != machine.error).alias("valid"), F.col("state").isin(*machine.last).alias("complete"))
