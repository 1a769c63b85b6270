"""Operator 3: exact round trips, and the digests against DuckDB."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import rows
from lotguard.llm import chat_format as C
from oracle_harness import compare, duck

PIECES = ["###", "#", "####", "\\", "</turn>", "</tur", "n>", "<", "### Assistant: ", ": ", "\n", "é", "ok", " ", "*"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=600, deadline=None)
@given(TEXT, TEXT)
def test_round_trip(role, text):
    data = C.format_turn(role, text)
    r, t, begin, end = C.parse_turn(data)
    assert (r, t) == (role, text)
    body = data[begin:end]
    assert data[end:] == "</turn>\n"
    assert body == text or C.CONTROL.search(text)


def test_escapes_only_conflicts():
    assert C.format_turn("user", r"a\b # ##") == "### user: a\\b # ##</turn>\n"
    assert C.format_turn("user", "####") == "### user*: \\#\\#\\#\\#</turn>\n"
    assert C.parse_turn(C.format_turn("assistant", C.ODD))[1] == C.ODD


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", 3) for d in data], "conv_id long, turn long, role string, text string, formatted string, loss_begin int")


def test_digests(spark):
    data = [(1, 2, "assistant", "b ### </turn>"), (1, 0, "system", ""), (1, 1, "user", None), (1, 3, None, "x"), (None, 0, "user", "n"), (2, None, "user", "z"),
            (2, 0, "assistant", "é" * 3), (2, 0, "assistant", "é" * 3), (2, 0, "assistant", "a"), (3, 5, "user", "### " * 50000)]
    got = {r["conv_id"]: r for r in rows(C.read_back(C.formatted(frame(spark, data))))}
    texts = {}
    key = lambda d: (d[1] is not None, d[1] or 0, d[2] is not None, d[2] or "", d[3] is not None, d[3] or "")
    for conv in {d[0] for d in data}:
        turns = sorted((d for d in data if d[0] == conv), key=key)
        r = got[conv]
        sha = hashlib.sha256("".join(f"{d[2] or ''}\n{d[3] or ''}\n" for d in turns).encode()).hexdigest()
        loss = "".join(d[3] or "" for d in turns if d[2] == "assistant")
        texts[conv] = "".join(C.format_turn(d[2] or "", d[3] or "") for d in turns)
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == (
            len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(texts[conv]),
        )
    assert set(got) == set(texts)


def test_empty(spark):
    assert rows(C.read_back(C.formatted(frame(spark, [])))) == []


def test_oracle(spark):
    d = "/root/testdata/sf0.01"
    r = compare(spark, d, "op3", C.op3_chat_format, C.SQL["op3_chat_format"], duck(d))
    assert r["schema"] and r["hash"] and r["rows"] == r["oracle_rows"], r


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=5), st.randoms(use_true_random=False))
def test_turns_of_a_text_cut_anywhere(turns, rnd):
    """The grammar finds the turns, wherever the text is cut into pieces."""
    whole = "".join(C.format_turn(*t) for t in turns)
    cuts = sorted(rnd.randint(0, len(whole)) for _ in range(4))
    stream, found = C.Turns(), []
    for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True):
        found += list(stream.feed(whole[a:b]))
    stream.close()
    assert [(r, t) for r, t, *_ in found] == turns
    for (r, t, a, b), (role, text) in zip(found, turns, strict=True):
        assert (r, t) == (role, text) and whole[b : b + 8] == "</turn>\n" and (whole[a:b] == text or C.CONTROL.search(text))


def test_what_is_no_conversation():
    for bad in ("### user: a", "### user: a</turn>\nx", "x", "### us\ner: a</turn>\n", "### user: a</turn> ### user: b</turn>\n", "### user: ### a</turn>\n"):
        stream = C.Turns()
        with pytest.raises(C.GrammarError):
            list(stream.feed(bad))
            stream.close()


def test_rows_need_not_hold_whole_turns(spark):
    """Two turns in one row, and a turn over two rows."""
    one, two = C.format_turn("user", "q ### </turn>"), C.format_turn("assistant", "r")
    begin, end = C.parse_turn(two)[2:]
    data = [(1, one + two, len(one) + begin, len(one) + end), (2, one[:9], None, None), (2, one[9:], None, None), (2, two, begin, end)]
    df = spark.createDataFrame(data, "conv_id long, formatted string, loss_begin long, loss_end long").coalesce(1)
    a, b = sorted(rows(C.read_back(df)), key=lambda r: r["conv_id"])
    assert {k: v for k, v in a.items() if k != "conv_id"} == {k: v for k, v in b.items() if k != "conv_id"} and a["n_turns"] == 2 and a["loss_chars"] == 1
