"""Chat formatting with a grammar round trip.

A turn is rendered by its role, parsed again by one deterministic grammar and compared to its source.  If they differ,
or the parser finds a control string inside a text, the content conflicts: then one more backslash goes into each of
its control strings, and it is compared again.  Since escaping adds one backslash to any control string that has k of
them after its first character, and parsing takes one away, that is identical, and texts without control strings stay
as they are.

    turn := "<s>" ( "[INST] " text " [/INST]"        user
                  | "<<SYS>> " text " <</SYS>>"      system
                  | "<|role|>" role "<|text|>" text "</s>"
                  | text "</s>" )                     assistant

Rows of a conversation are ordered by turn (nulls first), then role and text, so ties have one order.  Null roles
and texts are empty; rows of a null conversation form one; columns called like the new ones are replaced, all others
keep their values.  Rendering and parsing are by row; only the digests need
a conversation's rows in order, and they stream over sorted rows, so memory doesn't grow with a conversation.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import extended, quoted

CONTROL = r"/?s>|/?INST\]|<SYS>>|</SYS>>|\|role\|>|\|text\|>"
CLASH = re.compile(rf"([<\[])(\\*)({CONTROL})")
BARE = re.compile(rf"[<\[](?:{CONTROL})")
QUOTED = re.compile(rf"([<\[])\\(\\*)({CONTROL})")
TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|<\|role\|>(?P<role>.*?)<\|text\|>(?P<other>.*?)</s>|(?P<assistant>(?!\[INST\]|<<SYS>>|<\|role\|>).*?)</s>)",
    re.DOTALL,
)


def escape(text: str) -> str:
    return CLASH.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return QUOTED.sub(r"\1\2\3", text)


def layout(role: str, text: str, own_role: str) -> str:
    if role == "user":
        return f"<s>[INST] {text} [/INST]"
    if role == "system":
        return f"<s><<SYS>> {text} <</SYS>>"
    if role == "assistant":
        return f"<s>{text}</s>"
    return f"<s><|role|>{own_role}<|text|>{text}</s>"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the escaped text.

    Raises if anything is left over, or a text or role holds a control string that isn't escaped.
    """
    out, pos = [], 0
    while pos < len(formatted):
        m = TURN.match(formatted, pos)
        if not m:
            raise ValueError(f"no turn at character {pos}")
        kind = m.lastgroup
        if BARE.search(m[kind]) or kind == "other" and BARE.search(m["role"]):
            raise ValueError(f"a control string inside the turn at character {pos}")
        role = unescape(m["role"]) if kind == "other" else kind
        out.append((role, unescape(m[kind]), *m.span(kind)))
        pos = m.end()
    return out


def render(role: str, text: str) -> str:
    """The turn, with content that conflicts escaped, once it parses to its source."""
    for own, own_role in ((text, role), (escape(text), escape(role))):
        out = layout(role, own, own_role)
        with suppress(ValueError):
            if [(r, t) for r, t, _, _ in parse(out)] == [(role, text)]:
                return out
    raise ValueError("a turn can't be formatted reversibly")


def format_turns(df: DataFrame, role: str = "role", text: str = "text", out: str = "formatted") -> DataFrame:
    """Adds the rendered turn, and loss_start and loss_end: the characters of it that count for the loss."""
    new = [out, "loss_start", "loss_end"]
    kept = [c for c in df.columns if c not in new]
    df = df.select(*(quoted(c) for c in kept))
    schema = extended(df, f"{out} string, loss_start int, loss_end int")
    r, t = kept.index(role), kept.index(text)

    def run(batches):
        for batch in batches:
            done = [render(a or "", b or "") for a, b in zip(batch.column(r).to_pylist(), batch.column(t).to_pylist(), strict=True)]
            spans = [parse(x)[0] for x in done]
            loss = [(s, e) if kind == "assistant" else (0, 0) for kind, _, s, e in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done), *(pa.array([x[i] for x in loss], pa.int32()) for i in (0, 1))], names=[*kept, *new])

    return df.mapInArrow(run, schema)


def digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", formatted: str = "formatted", role: str = "role") -> DataFrame:
    """One row per conversation, read back from the rendered turns by the parser."""
    rows = turns.select(quoted(conv).cast("bigint").alias("conv"), quoted(turn).alias("turn"), F.coalesce(quoted(role), F.lit("")).alias("role"), quoted(formatted).alias("formatted"), "loss_start", "loss_end")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "formatted"]
    rows = rows.repartition(F.col("conv")).sortWithinPartitions(*order).select("conv", "formatted", "loss_start", "loss_end")
    schema = f"{conv} bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches):
        none = object()
        key, state = none, None

        def row():
            n, all_turns, chars, loss, total = state
            return [key, n, all_turns.hexdigest(), chars, loss.hexdigest(), total]

        def batch_of(done):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            done = []
            for own, text, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key or key is none:
                    if state:
                        done.append(row())
                    key, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                masked = unescape(text[start:end])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(text)
            if done:
                yield batch_of(done)
        if state:
            yield batch_of([row()])

    return rows.mapInArrow(run, schema)
