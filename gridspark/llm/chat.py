"""Chat formatting by a grammar round trip (operator 7).

conversation := "<s>" turn*
turn         := "[INST] " text " [/INST]"                    user
              | "[OUT] " text " </s>"                        assistant
              | "[TURN:" role "] " text " [/TURN]"           any other role

Every turn is rendered and parsed again; where the turn found differs from the
source, it is rendered with its control strings escaped. The conversation as a
whole is then parsed and compared, and whatever still differs is escaped too,
until both are identical. An escape is one more backslash before a
control string (after those that stand there already), and the parser takes
one away, so that any text survives. Roles are percent-encoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings as a regular expression (Python's, Java's and RE2's alike).
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]|\[OUT\]|\[/TURN\]|\[TURN:[^\]\[]*\]"
#: A control string and all backslashes before it; a run of them is read once.
_ACTIVE = re.compile(rf"(?<!\\)(\\*+)({CONTROL})")


def escape(text: str) -> str:
    return _ACTIVE.sub(lambda m: "\\" + m[0], text)


def _frame(role: str) -> tuple[str, str]:
    if role == "user":
        return "[INST] ", " [/INST]"
    if role == "assistant":
        return "[OUT] ", " </s>"
    return f"[TURN:{quote(role, safe='')}] ", " [/TURN]"


def render(turns: list[tuple[str, str]], escaped: set[int] = frozenset()) -> str:
    out = ["<s>"]
    for k, (role, text) in enumerate(turns):
        a, b = _frame(role)
        out += [a, escape(text) if k in escaped else text, b]
    return "".join(out)


def parse(s: str) -> tuple[list[tuple[str, str]], list[tuple[int, int]], bool]:
    """Turns, the spans of their (still escaped) texts, and whether all of s
    fits the grammar; on a misfit the turns before it are returned."""
    if not s.startswith("<s>"):
        return [], [], False
    turns, spans, at = [], [], 3
    controls = ((m.start(2), m[2], m.end()) for m in _ACTIVE.finditer(s, 3) if not m[1])
    for start, open_, end in controls:
        if start != at or s[end : end + 1] != " ":
            return turns, spans, False
        if open_ == "[INST]":
            role, close = "user", "[/INST]"
        elif open_ == "[OUT]":
            role, close = "assistant", "</s>"
        elif open_.startswith("[TURN:"):
            role, close = unquote(open_[6:-1]), "[/TURN]"
        else:
            return turns, spans, False
        stop = next(controls, None)
        if stop is None or stop[1] != close or stop[0] < end + 2 or s[stop[0] - 1] != " ":
            return turns, spans, False
        spans.append((end + 1, stop[0] - 1))
        turns.append((role, _ACTIVE.sub(lambda m: m[0][1:], s[end + 1 : stop[0] - 1])))
        at = stop[2]
    return turns, spans, at == len(s)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points, end exclusive) of
    the assistant's texts in it, the loss mask. Work grows with the text."""
    escaped = {k for k, t in enumerate(turns) if (alone := parse(render([t])))[0] != [t] or not alone[2]}
    while True:
        s = render(turns, escaped)
        got, spans, fits = parse(s)
        if fits and got == turns:
            return s, [p for p, (role, _) in zip(spans, turns, strict=True) if role == "assistant"]
        if len(escaped) == len(turns):
            raise ValueError("the grammar does not round-trip")
        escaped = set(range(len(turns)))


def formatted(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans): one row per conversation.

    Turns are ordered by turn (null first), then role and text, so that ties and
    repeated rows have one order. Null text and null role: empty. Null conv_id is
    a conversation of its own. A conversation's turns meet in one row because
    its output is one string; different conversations, however alike, do not.
    Texts of any length are taken whole; an empty table gives no rows, and other
    columns are ignored whatever their names.
    """
    s = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = turns.groupBy(F.col(conv_id).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(s)).alias("turns"))
    rows = rows.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, spans, n = [], [], []
            for roles, texts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                s, p = format_turns(list(zip(roles, texts, strict=True)))
                out.append(s)
                spans.append([{"start": x, "end": y} for x, y in p])
                n.append(len(roles))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, pa.string()), pa.array(spans, kind)], names=["conv_id", "n_turns", "formatted", "loss_spans"])

    return rows.mapInArrow(run, "conv_id long, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>")


def read_back(rows: DataFrame) -> DataFrame:
    """Parse formatted conversations again: (conv_id, roles, texts, loss_text),
    loss_text being all that the loss spans cover, unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, texts, loss = [], [], []
            for s, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns, _, fits = parse(s)
                if not fits:
                    raise ValueError("not a formatted conversation")
                roles.append([r for r, _ in turns])
                texts.append([t for _, t in turns])
                loss.append("".join(_ACTIVE.sub(lambda m: m[0][1:], s[p["start"] : p["end"]]) for p in spans))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), pa.array(loss, pa.string()), b.column(1)], names=["conv_id", "roles", "texts", "loss_text", "formatted"])

    return rows.select("conv_id", "formatted", "loss_spans").mapInArrow(run, "conv_id long, roles array<string>, texts array<string>, loss_text string, formatted string")
