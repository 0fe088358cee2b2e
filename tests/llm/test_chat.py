from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string"
TRICKY = ["<|end|>", "<|turn|>user<|text|>x", "\\", "\\\\<|", "<", "|>", "</s>[INST] ok [/INST]", "[INST", "<\\|end|>"]
TRICKY += ["$1 \\1", "🙂 é\n\n", "", "<<SYS>>", "<|<|text|>|", "tail <", "\\n"]


def fold(events):
    out = {}
    for e in sorted(events, key=lambda e: (e[2], e[3], e[5] or "")):
        key = (e[0], e[1])
        seq, role, text = out.get(key, (e[2], None, ""))
        role = e[4] if role is None else role
        part = e[5] or ""
        text = {"message": part, "edit": part, "regenerate": "", "delta": text + part}[e[3]]
        out[key] = (seq, role, text)
    return {(c, *v) for (c, _), v in out.items()}


def test_events_fold_into_the_last_version(spark):
    rng = random.Random(5)
    events = []
    for conv in range(6):
        for seq in range(40):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            role = rng.choice([None, "user", "assistant"])
            events.append((conv, rng.randrange(5), seq, kind, role, rng.choice([*TRICKY, None])))
    frame = spark.createDataFrame([*events, (0, 99, 1, "ping", "user", "x")], SCHEMA).repartition(4)
    got = {(r.conv_id, r.seq, r.role, r.text) for r in chat.folded(frame).collect()}
    assert got == fold(events)


def test_round_trip_of_control_strings(spark):
    rng = random.Random(6)
    turns = [
        (conv, seq, rng.choice(["user", "assistant", "<|end|>", None]), "".join(rng.choices(TRICKY, k=rng.randint(0, 4))))
        for conv in range(30)
        for seq in range(rng.randint(1, 8))
    ]
    frame = spark.createDataFrame([*turns, (None, 0, "assistant", None)], "conv_id long, seq long, role string, text string")
    formatted = chat.rendered(frame.repartition(3))
    for row in chat.read_back(formatted).collect():
        want = sorted((t for t in turns if t[0] == row.conv_id), key=lambda t: t[1])
        if row.conv_id is None:
            want = [(None, 0, "assistant", "")]
        assert [(t.role, t.text) for t in row.turns] == [(t[2] or "", t[3]) for t in want]
        assert row.loss == "".join(t[3] for t in want if t[2] == "assistant")
        assert row.formatted.count(chat.TURN) == row.formatted.count(chat.END) == len(want)
    for row in formatted.collect():
        for t in row.turns:
            part = row.formatted[t.start : t.start + t.length]
            assert part.startswith(chat.TURN) and part.endswith(chat.END)


def test_escaped_text_has_no_control_string(spark):
    frame = spark.createDataFrame([("".join(t),) for t in zip(TRICKY, TRICKY[1:])], "t string")
    for e, t, back in frame.select(chat.escaped(F.col("t")), "t", chat.unescaped(chat.escaped(F.col("t")))).collect():
        assert back == t
        assert not any(c in e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_repeated_rows_ties_extra_columns_and_empty(spark):
    rows = [(1, 0, "user", "a", 1), (1, 0, "user", "a", 1), (1, 0, "assistant", None, 2)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start int")
    back = chat.read_back(chat.rendered(chat.folded(chat.events_of(frame)))).collect()
    assert [[tuple(t) for t in r.turns] for r in back] == [[("assistant", ""), ("user", "a"), ("user", "a")]]
    assert chat.read_back(chat.rendered(chat.folded(chat.events_of(frame.limit(0))))).count() == 0


def test_a_log_of_streamed_edited_and_regenerated_turns_folds_into_the_turns(spark):
    rng = random.Random(8)
    rows = [
        (conv, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", "x", "🙂é", "".join(rng.choices(TRICKY, k=5)), "word " * 50]))
        for conv in range(40)
        for turn in range(5)
    ]
    rows += [(50, None, "user", "no turn"), (None, 3, "user", "no conversation"), (51, 7, "user", "twice"), (51, 7, "user", "twice"), (52, -3, "a", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("message", F.lit(1))
    log = chat.event_log(frame)
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate"} and kinds["delta"] > len(rows)
    # in any order
    back = chat.folded(log.orderBy(F.xxhash64("seq", "text")).repartition(3)).collect()
    key = lambda r: tuple(map(str, r))
    got = sorted(((r.conv_id, None if r.seq is None else r.seq // 16, r.role, r.text) for r in back), key=key)
    assert got == sorted(((c, t, r, x or "") for c, t, r, x in rows), key=key)
    assert chat.folded(chat.event_log(frame.limit(0))).count() == 0
