"""Chat formatting with a grammar round trip (operator 3).

Grammar of a formatted conversation:

    conversation = { turn }
    turn    = "### " role mark ": " body "</turn>" LF
    mark    = "" (plain body) | "*" (escaped body)
    role    = { char other than "\\", ":", "*", LF | "\\" char | "\\n" for LF }
    body    = { char }, without a control string; if escaped, "\\" and the
              character behind it stand for that character

Control strings are ``###`` and ``</turn>``. A turn is rendered plainly and
parsed again; if the turn that the parser recovers isn't the source, the
conflicting content is escaped: each backslash, each ``#`` in a run of three or
more, and the first character of each ``</turn>``. A rendering is used only
once parsing it gives the source back. The loss mask covers the bodies of
assistant turns.

A conversation is a sequence of rows, a turn each, in the order of ``turn``;
its formatted text is that of its rows put together. It is read back as one
text: where a turn ends and the next begins is for the grammar to say, and
text that is left over is an error. Conversations are sorted within tasks and
pass through piece by piece, so a conversation of any length needs the memory
of a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import table

HEAD, COLON, END = "### ", ": ", "</turn>"
CONTROL = re.compile(r"###|</turn>")
_ESCAPE = re.compile(r"\\|#(?=##)|(?<=#)#(?=#)|(?<=##)#|<(?=/turn>)")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"[\\:*\n]")
#: The roles whose bodies the loss covers.
LOSS_ROLE = "assistant"


class GrammarError(ValueError):
    """The text isn't a formatted turn."""


class Unfinished(GrammarError):
    """The text ends within a turn."""


def render_turn(role: str, text: str, escaped: bool) -> str:
    name = _ROLE.sub(lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role)
    body = _ESCAPE.sub(lambda m: "\\" + m[0], text) if escaped else text
    return f"{HEAD}{name}{'*' if escaped else ''}{COLON}{body}{END}\n"


def next_turn(data: str) -> tuple[str, str, int, int, int]:
    """The turn at the beginning of ``data``: role, text, where its body begins
    and ends, and where the turn ends."""
    if not data.startswith(HEAD):
        raise (Unfinished if HEAD.startswith(data) else GrammarError)("no turn begins here")
    role, at, escaped = [], len(HEAD), False
    while True:
        if at >= len(data):
            raise Unfinished("the role has no end")
        c = data[at]
        if c == "*":
            escaped, at = True, at + 1
            break
        if c == "\\":
            if at + 1 >= len(data):
                raise Unfinished("the role has no end")
            role.append("\n" if data[at + 1] == "n" else data[at + 1])
            at += 2
        elif c == ":":
            break
        elif c == "\n":
            raise GrammarError("a line feed in a role")
        else:
            role.append(c)
            at += 1
    if not data.startswith(COLON, at):
        raise (Unfinished if COLON.startswith(data[at:]) else GrammarError)("no colon behind the role")
    begin = at + len(COLON)
    # the turn ends at the first end mark that isn't escaped
    at = begin
    while True:
        m = CONTROL.search(data, at)
        if m is None:
            raise Unfinished("the turn has no end")
        if escaped:
            first = m.start()
            while first > begin and data[first - 1] == "\\":
                first -= 1
            if (m.start() - first) % 2:
                at = m.start() + 1
                continue
        break
    if m[0] != END:
        raise GrammarError("a control string in a body")
    if not data.startswith("\n", m.end()):
        raise (Unfinished if m.end() == len(data) else GrammarError)("no line feed behind a turn")
    body = data[begin : m.start()]
    return "".join(role), _UNESCAPE.sub(r"\1", body) if escaped else body, begin, m.start(), m.end() + 1


def parse_turn(data: str) -> tuple[str, str, int, int]:
    """Role, text, and where the body begins and ends in ``data``, which holds
    just one turn."""
    *turn, end = next_turn(data)
    if end != len(data):
        raise GrammarError("more than a turn")
    return tuple(turn)


class Turns:
    """The turns of a formatted conversation that comes in pieces, cut anywhere."""

    def __init__(self) -> None:
        self.rest, self.at = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        """The turns that are whole now: role, text, and where in the
        conversation the body begins and ends."""
        self.rest += piece
        begin = 0
        while begin < len(self.rest):
            try:
                role, text, a, b, end = next_turn(self.rest[begin:] if begin else self.rest)
            except Unfinished:
                break
            yield role, text, self.at + a, self.at + b
            begin, self.at = begin + end, self.at + end
        self.rest = self.rest[begin:]

    def close(self) -> None:
        if self.rest:
            raise GrammarError("the conversation ends within a turn")


def format_turn(role: str, text: str) -> str:
    """The plain rendering if it parses back to the turn, else the escaped one."""
    for escaped in (False, True):
        out = render_turn(role, text, escaped)
        try:
            if parse_turn(out)[:2] == (role, text):
                return out
        except GrammarError:
            continue
    raise GrammarError(f"no rendering of {role!r} parses back")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, spans = [], []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
            out.append(format_turn(role or "", text or ""))
            *_, begin, end = parse_turn(out[-1])
            spans.append((begin, end) if role == LOSS_ROLE else (None, None))
        begins, ends = zip(*spans, strict=True) if spans else ((), ())
        yield pa.record_batch(
            [batch.column("conv_id"), pa.array(out, pa.string()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())],
            names=["conv_id", "formatted", "loss_begin", "loss_end"],
        )


def formatted(turns: DataFrame) -> DataFrame:
    """A row for each turn (conv_id, turn, role, text): conv_id, formatted, and
    the characters of it that the loss mask covers (loss_begin, loss_end; null
    for other roles than assistant).

    Rows are in the order of conversations, and in them of turn (nulls first),
    ties by role and text, and stay so within a partition; a conversation lies
    in one partition. Null texts and roles count as empty, a null conv_id is a
    conversation like others. Further columns are left out.
    """
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_render, "conv_id long, formatted string, loss_begin long, loss_end long")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.turns, self.masked = Turns(), deque()

    def add(self, data: str, begin: int | None, end: int | None) -> None:
        """A piece of the conversation, and what of it the loss mask covers."""
        if begin is not None:
            self.masked.append((self.chars + begin, self.chars + end))
        self.chars += len(data)
        for role, text, *span in self.turns.feed(data):
            self.n += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if self.masked and self.masked[0][0] < span[1] + len(END):
                if self.masked.popleft() != tuple(span):
                    raise GrammarError("the loss mask doesn't cover a body")
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        self.turns.close()
        if self.masked:
            raise GrammarError("the loss mask covers no body")
        return self.conv_id, self.n, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current: _Digest | None = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)

    for batch in batches:
        done = []
        for conv, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_begin", "loss_end")), strict=True):
            if current is None or conv != current.conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv)
            current.add(*turn)
        yield out(done)
    if current is not None:
        yield out([current.row()])


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of conversations, parsed from their whole texts (the rows of
    ``formatted`` put together)."""
    return segments.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The turns of the conversation that the query adds.
ODD = r"\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)], "conv_id long, turn long, role string, text string")
    return read_back(formatted(turns.unionByName(odd)))


QUERIES = {"op3_chat_format": op3_chat_format}

SQL = {
    "op3_chat_format": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{ODD}' UNION ALL SELECT -7, 1, 'assistant', '{ODD}'
        ), f AS (
            SELECT *, CASE WHEN contains(text, '###') OR contains(text, '</turn>') THEN
                1 + length(text) - length(replace(text, '\', ''))
                  + length(text) - length(regexp_replace(text, '###+', '', 'g'))
                  + (length(text) - length(replace(text, '</turn>', ''))) // 7
                ELSE 0 END AS escapes
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(4 + length(role) + 2 + length(text) + 8 + escapes)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id
    """
}
