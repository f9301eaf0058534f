"""Conversations as one marked-up text each, with control strings in turns escaped so that they come back.

Every turn is rendered by itself and ends where its closing marker stands, so a conversation is its
rendered turns in order. The grammar::

    user       [INST] body [/INST]
    assistant  [ANSWER] body </s>
    system     <<SYS>> body <</SYS>>
    other      [ROLE "json string"] body [/ROLE]

Inside a body, a control string gets a backslash after its first character, or one more if it has some.
A turn is rendered, parsed by the deterministic parser and compared with its source; while they differ or
a control string stands unescaped, the next form is tried: as it is, escaped, and as a JSON string without
brackets (``[JSON]`` at its start), which cannot conflict.

A null text is empty, a null role is an empty role, rows with one ``turn`` are ordered by what is rendered,
a null ``conv_id`` is a conversation of its own. Repeated rows are turns of their own. Further columns are
ignored. An empty table has no conversation. A turn is a row from end to end; a conversation is
read in sorted order as a stream, so its length is not bounded by memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ANSWER] ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
_CONTROL = re.compile(r"([\[<])(\\*)(/?INST\]|ANSWER\]|/?s>|</?SYS>>|ROLE |/ROLE\]|JSON\])")
_ESCAPED = re.compile(r"([\[<])\\(\\*)(/?INST\]|ANSWER\]|/?s>|</?SYS>>|ROLE |/ROLE\]|JSON\])")
_OPEN = re.compile(r'\[INST\] |\[ANSWER\] |<<SYS>> |\[ROLE ("(?:[^"\\]|\\.)*")\] ', re.S)
_JSON = "[JSON]"
RENDERED = "conv_id long, turn long, rendered string, loss_from long, loss_to long"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, loss_marked_chars long"
)


def _plain_json(text: str) -> str:
    """A JSON string in which no bracket stands as itself."""
    return json.dumps(text).replace("<", "\\u003c").replace("[", "\\u005b").replace("]", "\\u005d")


def _body(text: str, form: int) -> str:
    if form == 0:
        return text
    return _CONTROL.sub(r"\1\2\\\3", text) if form == 1 else _JSON + _plain_json(text)


def parse(text: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """The turn that starts at ``at``: role, text, start and end of the body, end of the turn."""
    opened = _OPEN.match(text, at)
    if not opened:
        raise ValueError("no turn starts here")
    if opened[1] is not None:
        role, close = json.loads(opened[1]), " [/ROLE]"
    else:
        role, (_, close) = next(x for x in MARKS.items() if x[1][0] == opened[0])
    end = text.find(close, opened.end())
    if end < 0:
        raise ValueError("a turn does not end")
    body = text[opened.end() : end]
    source = json.loads(body[len(_JSON) :]) if body.startswith(_JSON) else _ESCAPED.sub(r"\1\2\3", body)
    return role, source, opened.end(), end, end + len(close)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and start and end of the body in it."""
    opened, close = MARKS.get(role) or (f"[ROLE {_plain_json(role)}] ", " [/ROLE]")
    for form in range(3):
        body = _body(text, form)
        if form == 0 and _CONTROL.search(body):
            continue
        rendered = opened + body + close
        try:
            found = parse(rendered)
        except ValueError:
            continue
        if found == (role, text, len(opened), len(opened) + len(body), len(rendered)):
            return rendered, len(opened), len(opened) + len(body)
    raise AssertionError("a JSON body reads back as it was")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, turn, rendered`` and the part under the loss mask (null: none); no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            roles, texts = (batch.column(c).fill_null("").to_pylist() for c in ("role", "text"))
            rows = [render(r, t) for r, t in zip(roles, texts, strict=True)]
            spans = [(a, b) if r == "assistant" else (None, None) for r, (_, a, b) in zip(roles, rows, strict=True)]
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([s[0] for s in spans], pa.int64()),
                    pa.array([s[1] for s in spans], pa.int64()),
                ],
                [c.split()[0] for c in RENDERED.split(", ")],
            )

    ids = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    texts = [F.col(c).cast("string").alias(c) for c in ("role", "text")]
    return conversations.select(*ids, *texts).mapInArrow(run, RENDERED)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests per conversation, from rendered turns alone: each is parsed, nothing is taken from the source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        done: list[tuple] = []

        def rows() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.record_batch(columns, [c.split()[0] for c in DIGESTS.split(", ")])

        def close() -> None:
            if state:
                n, turns_sum, chars, loss_sum, formatted, marked = state
                done.append((current, n, turns_sum.hexdigest(), chars, loss_sum.hexdigest(), formatted, marked))

        for batch in batches:
            for conv, rendered, a, b in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if state is None or conv != current:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                at = 0
                while at < len(rendered):
                    role, text, start, end, at = parse(rendered, at)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if (a, b) == (start, end):
                        state[2] += len(text)
                        state[3].update(text.encode())
                        state[5] += end - start
                state[4] += len(rendered)
            if done:
                yield rows()
        close()
        if done:
            yield rows()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
    return ordered.mapInArrow(run, DIGESTS)
