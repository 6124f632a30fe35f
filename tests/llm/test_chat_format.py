from __future__ import annotations

from pyspark.sql import functions as F

from assaycast.llm import chat_format as cf

NASTY = [None, "", "### User: x", "</turn>", "\\### Assistant: </turn> ok", "\\h \\e \\s \\c", "#####", "</tur</turn>n>", "a\nb: c", "\\", "é🙂", "x" * 100_000]


def test_escapes_go_back_and_leave_no_mark(shipped):
    df = shipped.createDataFrame([(t,) for t in NASTY if t is not None], "t string")
    out = df.select("t", cf.escape(F.col("t")).alias("e"), cf.unescape(cf.escape(F.col("t"))).alias("u")).collect()
    assert all(r["t"] == r["u"] and "###" not in r["e"] and "</turn>" not in r["e"] for r in out)


def test_examples(shipped, clash):
    rows = [(1, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"), (2, 3, "assistant", "b"), (2, 4, "user", "last")]
    rows += [(3, 0, "user", "only")] + [(4, 0, "assistant", "same")] * 2 + [(None, 0, None, "no id"), (None, 1, "a: b", None), (5, None, "assistant", "x")]
    turns = clash(shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = cf.format_chats(turns.repartition(4)).select(
        "*", cf.parse_turns(F.col("text")).alias("turns"), cf.target_text(F.col("text"), F.col("target_start"), F.col("target_chars")).alias("loss")
    ).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["example"]):
        by.setdefault(r["conv_id"], []).append(r)
    for conv in {r[0] for r in rows}:
        own = sorted([(r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        ends = [i + 1 for i, t in enumerate(own) if t[1] == "assistant" or i + 1 == len(own)]
        assert [r["n_turns"] for r in by[conv]] == ends
        for r in by[conv]:
            assert [tuple(t) for t in r["turns"]] == [t[1:] for t in own[: r["n_turns"]]]
            last = own[r["n_turns"] - 1]
            assert r["loss"] == (last[2] if last[1] == "assistant" else None)
            assert r["is_last"] == (r["n_turns"] == len(own))
    assert cf.format_chats(turns.limit(0)).count() == 0


def test_no_python_in_the_plan(shipped):
    turns = shipped.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = cf.format_chats(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
