"""Chat formatting in windows of a token budget.

A conversation is cut between turns: running sums of turn tokens decide which turns a window takes. Every
window behind it opens with the conversation's first system turn, repeats the latest earlier turns as far as the history
budget and the window's own go, and then holds new turns. The loss mask covers the text of new assistant turns, so each is
learned once; repeated turns carry no loss. A turn is never cut: a window exceeds the budget only if the system turn and one
new turn do.

Rows are dealt by conversation and read in order (turn, role, text; nulls first) as a stream: memory holds one window,
however long a conversation is. One conversation is read by one task, since windows depend on those before.
Null texts and roles are empty. A null conversation id is one conversation. Repeated rows are repeated turns.

Control strings inside texts are escaped: between ``<`` and ``|`` stands one backslash more than before.
Roles escape backslashes and line ends too. Both are undone exactly by ``parse_window``.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 1024, 256
#: Tokens a turn's frame counts for.
FRAME = 4
# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"

_ESCAPE, _PLAIN = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_WINDOW_SCHEMA = "conv_id {kind}, window bigint, formatted string, repeated bigint, n_tokens bigint, loss array<struct<start:bigint,stop:bigint>>"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


def count_words(text: str) -> int:
    """The default measure of tokens: words between white space."""
    return len(text.split())


def windows(turns: Iterator[tuple[str, str]], budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_words) -> Iterator[tuple]:
    """(formatted, repeated turns, tokens, loss spans) of each window of one conversation's (role, text) turns."""
    system, past, past_tokens = None, deque(), 0
    held, held_tokens, lead = [], 0, []

    def render():
        parts, at, loss = [], 0, []
        for i, (role, text, _) in enumerate(lead + held):
            body, head = escape(text), f"{START}{escape_role(role)}\n"
            if i >= len(lead) and role == "assistant":
                loss.append((at + len(head), at + len(head) + len(body)))
            parts.append(f"{head}{body}{END}\n")
            at += len(parts[-1])
        return "".join(parts), len(lead), held_tokens, loss

    for role, text in turns:
        size = count(text) + FRAME
        if held and held_tokens + size > budget:
            yield render()
            # Repeat the latest turns that fit, then let new ones follow.
            lead, room, recent = ([system] if system else []), history, []
            used = sum(t[2] for t in lead) + size
            for turn in reversed(past):
                if turn[2] > room or used + turn[2] > budget:
                    break
                recent.append(turn)
                room -= turn[2]
                used += turn[2]
            lead += reversed(recent)
            held, held_tokens = [], sum(t[2] for t in lead)
        turn = (role, text, size)
        held.append(turn)
        held_tokens += size
        if role == "system" and system is None:
            system = turn
            continue
        past.append(turn)
        past_tokens += size
        while past and past_tokens - past[0][2] >= history:
            past_tokens -= past.popleft()[2]
    if held:
        yield render()


def parse_window(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    return [
        (unescape_role(head), unescape(body))
        for head, _, body in (turn.partition("\n") for turn in (piece.removeprefix(START) for piece in formatted.split(f"{END}\n")[:-1]))
    ]


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of record batches as tuples of Python values."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns))


def _groups(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, rows without it) for each run of equal first values; nothing of a run is held."""
    from itertools import groupby

    for key, run in groupby(rows, key=lambda r: r[0]):
        yield key, (r[1:] for r in run)


def _flush(rows: Iterator[tuple], names: list[str], types: list, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_words,
) -> DataFrame:
    """Windows: conv_id, window, formatted, repeated (leading turns shown before), n_tokens, loss (spans of code points)."""
    rows = turns.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("n"), F.col(role_col).alias("r"), F.col(text_col).alias("t"))
    ordered = rows.repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        first = next(batches, None)
        if first is None:
            return

        def every():
            yield first
            yield from batches

        def rows():
            for conv, own in _groups(_by_key(every())):
                said = ((role or "", text or "") for role, text in own)
                for i, (text, repeated, tokens, loss) in enumerate(windows(said, budget, history, count)):
                    yield conv, i, text, repeated, tokens, [{"start": a, "stop": b} for a, b in loss]

        names = ["conv_id", "window", "formatted", "repeated", "n_tokens", "loss"]
        yield from _flush(rows(), names, [first.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), spans])

    return ordered.mapInArrow(run, _WINDOW_SCHEMA.format(kind=rows.schema["c"].dataType.simpleString()))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window").select("conv_id", "formatted", "repeated", "loss")

    def run(batches):
        first = next(batches, None)
        if first is None:
            return

        def every():
            yield first
            yield from batches

        def rows():
            for conv, own in _groups(_by_key(every())):
                turns, learned, n, chars, total = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for text, repeated, loss in own:
                    total += len(text)
                    for role, said in parse_window(text)[repeated:]:
                        turns.update(f"{role}\n{said}\n".encode())
                        n += 1
                    for span in loss:
                        part = unescape(text[span["start"]:span["stop"]])
                        learned.update(part.encode())
                        chars += len(part)
                yield conv, n, turns.hexdigest(), chars, learned.hexdigest(), total

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield from _flush(rows(), names, [first.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
