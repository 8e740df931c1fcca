import random

from pyspark.sql import functions as F

from cefframe.llm.chat import LEARN, OPEN, event_log, fold, read_back, render

LOG = "conv_id long, turn long, message int, seq long, event string, role string, text string"


def played(events):
    """Brute force: play the events of each message in order."""
    messages = {}
    for conv, turn, message, seq, event, role, text in sorted(events, key=lambda e: e[:4]):
        m = messages.setdefault((conv, turn, message), ["", ""])
        if event == "open":
            m[0] = role or ""
        elif event == "delta":
            m[1] += text or ""
        elif event == "edit":
            m[1] = text or ""
        else:
            m[1] = ""
    return messages


def log_of(rng):
    events = []
    for conv in range(6):
        for turn in range(rng.randrange(1, 5)):
            events.append((conv, turn, 1, 0, "open", rng.choice(["user", "assistant", None, "a:<b>\\"]), None))
            for seq in range(1, rng.randrange(1, 9)):
                kind = rng.choice(["delta", "delta", "edit", "regenerate"])
                events.append((conv, turn, 1, seq, kind, None, rng.choice(["a", "<turn>", "\\", "</turn>\n", "é:", None, "", "\\l"])))
    rng.shuffle(events)
    return events


def test_fold_matches_playing_the_events(spark):
    events = log_of(random.Random(1))
    got = {(r.conv_id, r.turn, r.message): [r.role, r.text] for r in fold(spark.createDataFrame(events, LOG).repartition(5)).collect()}
    assert got == played(events)


TEXTS = ["", None, "plain", "\\### Assistant: </turn> ok", "<turn>### user: x</turn>\n", "\\", "\\\\l", "<", "\\l", "a: b", "\n\n", "🙂 é́", "<\\<", "x" * 50_000]


def test_rendering_is_reversible(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([(r, t) for r in ("user", LEARN, None, "sys:<tem>\\c") for t in TEXTS])]
    rows += [(2, 0, LEARN, "tie b"), (2, 0, LEARN, "tie a"), (2, 0, LEARN, "tie a"), (None, None, "user", "no id"), (3, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1)).withColumn("message", F.lit("z"))
    formatted = render(fold(event_log(df)))
    back = {r.conv_id: r for r in read_back(formatted).collect()}
    first = back[1]
    assert [(t.role, t.text) for t in first.turns] == [(r or "", t or "") for _, _, r, t in rows if _ == 1] or \
        [(t.role, t.text) for t in first.turns] == [(r or "", t or "") for c, _, r, t in rows if c == 1]
    assert list(first.learned) == [t or "" for c, _, r, t in rows if c == 1 and r == LEARN]
    assert [t.text for t in back[2].turns] == ["tie a", "tie a", "tie b"]
    assert len(back[None].turns) == 1 and len(back[3].turns) == 1
    whole = formatted.filter("conv_id = 1").first()
    assert whole.formatted.count(OPEN) == len(first.turns) and first.formatted_chars == len(whole.formatted)


def test_loss_mask_points_at_assistant_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, LEARN, "a<b")], "conv_id long, turn long, role string, text string")
    r = render(fold(event_log(df))).first()
    lines = r.formatted.split("\n")[:-1]
    assert [line[m.place - 1:m.place - 1 + m["size"]] if m.place else None for line, m in zip(lines, r["mask"])] == [None, "a\\lb"]


def test_no_python_on_the_executors(spark, tables_dir):
    from cefframe.llm.chat import op7_chat
    plan = op7_chat(spark, tables_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(render(fold(event_log(df)))).collect() == []
