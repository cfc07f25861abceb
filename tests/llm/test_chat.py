import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewright.llm import chat

PARTS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "s>", "/s>", "INST]", "<", "[", "\n", "é", "x"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(PARTS)
def test_escape_is_reversible_and_leaves_no_control(text):
    made = chat.escape(pa.array([text]))[0].as_py()
    assert not any(c in made for c in chat.CONTROLS)
    assert chat.unescape(made.encode()).decode() == text


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        all_ = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(all_.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("segment", "large"), [(2, 1 << 20), (256, 1 << 20), (256, 3)])
def test_digests_match_the_rows(spark, monkeypatch, segment, large):
    monkeypatch.setattr(chat, "SEGMENT_TURNS", segment)
    monkeypatch.setattr(chat, "LARGE_BYTES", large)
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "é</s>[INST]", "x"), (1, 2, "assistant", "\\[/INST]\n", "x"),
        (2, 5, "assistant", None, "x"), (2, 5, None, "tie", "x"), (2, 5, None, "tie", "x"), (2, None, "user", "first", "x"),
        (None, 0, "assistant", "no conversation", "x"), (3, 0, "system", "", "x"), (4, 0, "we\nird<s>[INST]", "a" * 70_000, "x"),
        *[(9, i, "assistant" if i % 2 else "user", f"turn {i} é", "x") for i in range(-3, 30)],
    ]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_chat(frame(spark, rows))).collect()}
    assert got == expected(rows)


def test_formatted_texts_and_loss_spans(spark):
    rows = [(1, 1, "assistant", "é<s>b", ""), (1, 0, "user", "q", "")]
    r = chat.format_chat(frame(spark, rows)).first()
    assert r.formatted == "<s>user[INST]q[/INST]</s>\n<s>assistant[INST]é<\\s>b[/INST]</s>\n"
    assert [r.formatted[a:b] for a, b in zip(r.loss_starts, r.loss_ends, strict=True)] == ["é<\\s>b"]
    assert chat.digests(chat.format_chat(frame(spark, []))).count() == 0


def test_clashing_columns_and_a_very_long_text(spark):
    long = "<s>é\\ " * 1_000_000
    rows = [(1, 0, "user", long, ""), (1, 1, "assistant", long + "end", ""), (2, 0, "assistant", "short", "")]
    df = frame(spark, rows)
    for name in ("_turn", "_role", "_text", "_conv", "_null", "part", "n_turns", "formatted"):
        df = df.withColumn(name, F.lit("mine"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_chat(df)).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize(("rows_at_once", "size"), [(3, 8 << 20), (7, 8 << 20), (4096, 1)])
def test_parts_are_bounded_and_in_order(monkeypatch, rows_at_once, size):
    monkeypatch.setattr(chat, "PART_ROWS", rows_at_once)
    monkeypatch.setattr(chat, "PART_BYTES", size)
    runs = [0] * 20 + [1, 2] + [3] * 11 + [4] + [5] * 4
    rows = pa.record_batch([pa.array(runs), pa.array([f"r{i}" for i in range(len(runs))]), pa.array(["text"] * len(runs))], names=["k", "_role", "_text"])
    made = list(chat._parts(iter([rows.slice(i, 5) for i in range(0, len(runs), 5)]), ["k"]))
    assert [r for _, t in made for r in t.column("_role").to_pylist()] == rows.column("_role").to_pylist()
    seen = [(k, n) for n, t in made for k in sorted(set(t.column("k").to_pylist()))]
    assert seen == sorted(set(seen)) and {k for k, _ in seen} == {0, 1, 2, 3, 4, 5}
    assert all(n == 0 or len(set(t.column("k").to_pylist())) == 1 for n, t in made)
    assert all(t.num_rows <= min(rows_at_once, 10) for _, t in made)


def test_many_turns_of_one_number(spark):
    rows = [(1, None if i % 3 else 7, "assistant" if i % 2 else "user", f"text {i % 1717} é", "") for i in range(15_000)]
    made = chat.format_chat(frame(spark, rows)).collect()
    assert sum(r.n_turns for r in made) == 15_000 and max(r.n_turns for r in made) <= chat.PART_ROWS
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_chat(frame(spark, rows))).collect()}
    assert got == expected(rows)


def test_broken_output_is_noticed():
    with pytest.raises(ValueError):
        list(chat.read_turns(b"<s>a[INST]b[/INST]</s>\nx"))


@pytest.mark.parametrize("large", [0, 3, 1 << 20])
def test_slices_and_gather_agree(monkeypatch, large):
    import numpy as np

    monkeypatch.setattr(chat, "LARGE_BYTES", large)
    made, begins, ends = chat.assemble(pa.array(["user", "é", None]), pa.array(["abc", "", "[INST]x"]), np.array([0, 2, 3]))
    assert [x.as_py() for x in made] == [b"<s>user[INST]abc[/INST]</s>\n<s>\xc3\xa9[INST][/INST]</s>\n", b"<s>[INST][\\INST]x[/INST]</s>\n"]
    assert made[0].as_py()[begins[0] : ends[0]] == b"abc" and made[1].as_py()[begins[2] : ends[2]] == b"[\\INST]x"
