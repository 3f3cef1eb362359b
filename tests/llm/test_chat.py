import hashlib

import pyarrow as pa

from trolley.llm import chat


def test_control_strings_survive(spark):
    texts = ["<turn user>\nhi</turn>\n", "\\", "\\<", "</turn>", None, "", "é<😀>\\n", "<" * 3_000]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant"] * 4, texts, strict=True))] + [(None, None, None, None), (2, 1, "a>b\\", "x"), (2, 1, "a>b\\", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS pid")
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(turns)).collect()}
    spoken = "".join(t or "" for t in texts[1::2])
    whole = "".join(f"{r}\n{t or ''}\n" for r, t in zip(["user", "assistant"] * 4, texts, strict=True))
    assert out[1].n_turns == 8 and out[1].loss_chars == len(spoken)
    assert out[1].loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
    assert out[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert (out[2].n_turns, out[None].n_turns) == (2, 1)
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def test_long_conversation_comes_in_parts(spark, monkeypatch):
    rows = [(7, i, "assistant" if i % 2 else "user", f"{i} <\\ " * 300) for i in range(3_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_chats(turns)
    assert parts.count() > 1
    (row,) = chat.digests(parts).collect()
    assert row.n_turns == 3_000
    assert row.loss_sha256 == hashlib.sha256("".join(t for _, i, _, t in rows if i % 2).encode()).hexdigest()


def test_assembly_across_steps(monkeypatch):
    monkeypatch.setattr(chat, "STEP", 3)
    roles, texts = ["user", "", "a<"], ["\\<\\<x", "", "é<é<"]
    out, turns, begin, end = chat.assemble(pa.array(roles), pa.array(texts))
    raw = out.tobytes()
    assert [*chat.read_turns(raw)] == [(r.encode(), t.encode()) for r, t in zip(roles, texts, strict=True)]
    assert [chat.unescape(raw[a:b]).decode() for a, b in zip(begin, end, strict=True)] == texts
