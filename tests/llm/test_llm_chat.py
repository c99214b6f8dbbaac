import hashlib
import random

from conftest import SF001
from oracle_check import compare, duck
from sparkcount.llm import op01_chat_format as op
from sparkcount.llm import queries as Q

LOG = "conv_id long, seq long, turn long, role string, text string, event string, formatted string, m int"


def log(spark, rows):
    """Events with two extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], LOG)


def read(df):
    return {r.conv_id: r for r in op.read_back(df).collect()}


def test_events_fold_to_final_messages(spark):
    rows = [
        (1, 1, 0, "user", "hi", "message"), (1, 2, 1, "assistant", "He", "delta"), (1, 3, 1, "assistant", "llo", "delta"),
        (1, 4, 2, "user", "more", "message"), (1, 5, 0, "user", "hi!", "edit"),
        (1, 6, 1, "assistant", None, "regenerate"), (1, 7, 1, "assistant", "Bon", "delta"),
        (1, 8, 1, "assistant", "jour", "delta"), (1, 9, 2, "user", "thanks", "message"),
        (2, None, 0, None, None, None), (None, 1, 0, "user", "no conversation", "message"),
    ]
    got = read(op.render(op.fold(log(spark, rows))))
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "hi!"), ("assistant", "Bonjour"), ("user", "thanks")]
    assert got[1].loss_text == "Bonjour"
    assert [(t.role, t.text) for t in got[2].turns] == [("", "")]
    assert got[None].turns[0].text == "no conversation"


def test_control_strings_come_back(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x|> <|", "|", "<", "", "\n<|im_end|>\n", "%0A%", None,
             "x" * 50_000]
    rows = [(1, i, i, "assistant" if i % 2 else "a\n<|%", t, "message") for i, t in enumerate(texts)]
    got = read(op.render(op.fold(log(spark, rows), by_row=True)))[1]
    assert [t.text for t in got.turns] == [t or "" for t in texts]
    assert {t.role for t in got.turns} == {"assistant", "a\n<|%"}
    assert got.loss_text == "".join(t or "" for t in texts[1::2])
    assert got.formatted.count("<|im_start|>") == len(texts)


def test_repeated_turns_all_stay_and_summary(spark):
    rows = [(3, 1, 1, "user", "b", "message"), (3, 1, 1, "user", "a", "message"), (3, 1, 1, "user", "a", "message")]
    got = op.summary(op.read_back(op.render(op.fold(log(spark, rows), by_row=True)))).collect()[0]
    want = hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    assert (got.n_turns, got.turns_sha256, got.loss_chars) == (3, want, 0)
    assert got.loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_log(spark):
    assert op.summary(op.read_back(op.render(op.fold(log(spark, []))))).count() == 0


def test_query_matches_oracle(spark):
    r = compare(spark, duck(SF001), "op1", Q.QUERIES["op1_chat_format"], Q.ORACLE["op1_chat_format"], SF001)
    assert r["hash_ok"] and r["cols_ok"], r


def test_no_python_in_the_plan(spark):
    plan = Q.op1_chat_format(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_a_turn_fold_too(spark):
    """``by_row`` folds deltas, edits and regenerations beside repeated turns."""
    rows = [
        (1, 0, 0, "user", "same", "message"), (1, 0, 0, "user", "same", "message"), (1, 0, 0, "user", "other", "message"),
        (1, 1, 1, "assistant", "He", "message"), (1, 2, 1, None, "llo", "delta"), (1, 2, 1, None, "llo", "delta"),
        (1, 3, 2, "user", "gone", "message"), (1, 4, 1, "assistant", None, "regenerate"), (1, 5, 1, None, "Bon", "delta"),
        (1, 6, 2, "user", "b", "message"), (1, 6, 2, "user", "a", "message"), (1, 7, 2, None, "B", "edit"),
        (1, 8, 9000, "user", "far", "message"), (1, 9, 3, "user", None, "regenerate"), (None, 9, 0, None, None, "regenerate"),
        (None, 1, 5_000_000, "user", "gone", "message"), (None, 10, 5_000_001, "user", "stays", "message"),
    ]
    got = read(op.render(op.fold(log(spark, rows), by_row=True)))
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("user", "other"), ("user", "same"), ("user", "same"), ("assistant", "Bon"), ("user", "a"), ("", "B"), ("user", "")]
    assert [t.text for t in got[None].turns] == ["", "stays"]


def by_hand(rows):
    """Final turns of a log, one event after another."""
    convs = {}
    least = lambda x: (x is not None, x or 0)
    for c, seq, turn, role, text, event in sorted(
            rows, key=lambda r: (str(r[0]), least(r[1]), least(r[2]), r[5] or "message", r[3] or "", r[4] or "")):
        turns = convs.setdefault(c, {})
        if event == "regenerate" and turn is not None:
            for t in [t for t in turns if t is not None and t > turn]:
                del turns[t]
        if event != "delta":
            turns[turn] = []
        turns.setdefault(turn, []).append((role or "", text or ""))
    return {c: [(next((r for r, _ in turns[t] if r), ""), "".join(x for _, x in turns[t])) for t in sorted(turns, key=least)]
            for c, turns in convs.items()}


def test_fold_is_the_replay_by_hand(spark):
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(60)]), rng.choice([None, 0, 1, 2, 3, 1500, 3_000_000]),
             rng.choice(["user", "assistant", None]), rng.choice("abcd"),
             rng.choice(["message", "delta", "delta", "edit", "regenerate", None])) for _ in range(150)]
    got = read(op.render(op.fold(log(spark, rows))))
    assert {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()} == by_hand(rows)
