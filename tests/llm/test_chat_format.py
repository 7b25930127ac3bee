import hashlib

import pytest
from pyspark.sql import functions as F

from opinara.llm.chat_format import INSTRUCT, ChatTemplate, RoleMarks, digest, escape, format_chats, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, valid string"
NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]\\", "[IN\\ST]", "<<SYS>>[AS][/TURN]", "<\\s>", "", "é\n[TURN]x[AS]y[/TURN]"]


def chats(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_escape_is_reversible_and_hides_control_strings(spark):
    texts = NASTY + [a + b for a in NASTY for b in NASTY]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t"), INSTRUCT).alias("e"))
    for r in df.withColumn("back", unescape(F.col("e"))).collect():
        assert r.back == r.t
        assert not any(c in r.e for c in INSTRUCT.controls)


def test_digests_read_back_equal_plain_python(spark):
    rows = [(k, i, role, t) for k, t in enumerate(NASTY) for i, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(50, 0, "critic [AS]", "x"), (50, 1, None, None), (50, 2, "assistant", None)]
    got = {r.conv_id: r for r in digest(format_chats(chats(spark, rows))).collect()}
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        loss = [t for role, t in own if role == "assistant"]
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == sha(f"{a}\n{b}\n" for a, b in own)
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len("".join(loss)), sha(loss))
    assert not got[50].valid


def test_machine_checks_turn_order(spark):
    orders = [["user", "assistant"], ["system", "user", "assistant"], ["assistant"], ["user", "user", "assistant"], ["user"], ["user", "system"]]
    rows = [(k, i, role, "t") for k, order in enumerate(orders) for i, role in enumerate(order)]
    got = {r.conv_id: (r.valid, r.state) for r in format_chats(chats(spark, rows)).collect()}
    assert got == {0: (True, "answered"), 1: (True, "answered"), 2: (False, "error"), 3: (False, "error"), 4: (False, "asked"), 5: (False, "error")}


def test_segments_carry_loss_flags_and_spans(spark):
    row = format_chats(chats(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")])).first()
    assert [(s.text, s.loss) for s in row.segments] == [
        ("[INST]", False), ("hi", False), ("[/INST]", False), ("<s>", False), ("yo", True), ("</s>", False)]
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == ["yo"]


def test_ties_repeats_null_ids_and_empty_tables(spark):
    rows = [(None, 0, "user", "n"), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (2, 0, "assistant", "z" * 200_000)]
    got = {r.conv_id: r for r in format_chats(chats(spark, rows)).withColumn("turns", read_turns(F.col("formatted"))).collect()}
    assert [t.text for t in got[1].turns] == ["s", "a", "b", "b"]
    assert got[None].n_turns == 1 and len(got[2].turns[0].text) == 200_000
    assert digest(format_chats(chats(spark, []))).count() == 0


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError, match="opening"):
        ChatTemplate({"a": RoleMarks("<a>", "</a>"), "b": RoleMarks("<a>", "</b>")})
    with pytest.raises(ValueError, match="part of another"):
        ChatTemplate({"a": RoleMarks("<a>", "<a>x")})
