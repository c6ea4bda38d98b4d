"""Chat formatting."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from mediapanel.llm import chat_format as chat

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[ASST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/TEXT]", "[NEXT]"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return df.withColumns({"turns": F.lit("clash"), "heads": F.lit(1), "formatted": F.lit("f"), "mask": F.lit(0)})


def awkward(seed=1):
    rng = random.Random(seed)
    rows = []
    bits = MARKS + ["\\", "<", "[", "]", ">", "/s>", "INST]", "a", "é\n", "日本🎉", " ", "$1", "", "<\\s>", "[\\\\INST]", "\x00"]
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "[ROLE]", None, "a[TEXT]b", "\\", ""])
            text = None if rng.random() < 0.1 else "".join(rng.choices(bits, k=rng.randint(0, 12)))
            rows.append((conv, turn, role, text))
    rows += [(100, 0, "user", ""), (101, 0, "assistant", None), (102, None, "user", "no turn"), (102, 0, "user", "a turn"),
             (None, 0, "user", "no id"), (103, 5, "user", "x"), (103, 5, "assistant", "tie"), (103, 5, "assistant", "tie"),
             (104, 0, "assistant", "<s>" * 50_000 + "x" * 300_000), (104, 1, "assistant", "[" * 100_000)]
    rows += [(105, i, "user" if i % 7 else "assistant", f"turn {i}") for i in range(2000)]
    return rows


def turns_of(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in out.items()}


def test_turns_come_back_from_the_text(spark):
    rows = awkward()
    made = chat.format_conversations(frame(spark, rows))
    got = made.select("conv_id", "formatted", "mask", chat.read_turns(F.col("formatted")).alias("turns"),
                      F.transform(chat.loss_texts(F.col("formatted"), F.col("mask")), chat.unescaped).alias("loss")).collect()
    want = turns_of(rows)
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        read = [(t.role, t.text) for t in r.turns]
        if r.conv_id == 103:  # a tie: the role decides
            assert read == [("assistant", "tie"), ("assistant", "tie"), ("user", "x")]
        assert read == turns
        assert r.loss == [t for role, t in turns if role == "assistant" and t]
        assert sum(m.chars for m in r.mask) == len(r.formatted) and all(m.chars > 0 for m in r.mask)
        # Blocks are as many as changes of role, and only marks of the template are marks.
        changes = sum(1 for i, t in enumerate(turns) if i == 0 or turns[i - 1][0] != t[0])
        assert sum(r.formatted.count(o) for o in ("[INST]", "[ASST]", "[SYS]", "[ROLE]")) == changes
        assert r.formatted.count("[NEXT]") == len(turns) - changes and r.formatted.count("<s>") == 1
        at, under = 0, []
        for m in r.mask:
            if m.loss:
                under.append(r.formatted[at:at + m.chars])
            at += m.chars
        assert not any(mark in u for u in under for mark in MARKS)


def test_digests(spark):
    marks = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", marks), (-7, 1, "assistant", marks), (1, 0, "user", "a"), (1, 1, "user", "b")]
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(frame(spark, rows))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[-7].n_turns == 2 and got[-7].loss_sha256 == sha(marks) and got[-7].loss_chars == len(marks)
    assert got[-7].turns_sha256 == sha(f"user\n{marks}\nassistant\n{marks}\n")
    assert got[1].formatted_chars == len("<s>[INST]a[NEXT]b[/INST]") and got[1].loss_sha256 == sha("")


def test_escaping_is_reversible_and_hides_marks(spark):
    texts = [(m,) for m in MARKS] + [(m[0] + "\\" * k + m[1:],) for m in MARKS for k in range(4)]
    texts += [("<<s>",), ("[[INST]]",), ("<s",), ("\\<s>",), ("$1\\$2",), ("<\\\\\\x",)]
    rows = spark.createDataFrame(texts, "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t and not any(m in r.e for m in MARKS)


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(frame(spark, [(1, 0, "user", "x")]).limit(0))).count() == 0


def test_plan_is_native(spark):
    plan = chat.digests(chat.format_conversations(frame(spark, awkward())))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
