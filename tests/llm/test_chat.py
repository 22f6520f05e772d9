"""Chat formatting: folding of event logs, reversible rendering, the loss mask."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import chat

LOG = "conv_id long, position long, message_id long, seq long, kind string, role string, text string, body string"


def final(spark, events):
    rows = chat.messages(spark.createDataFrame([(*e, "clash") for e in events], LOG)).collect()
    return {(r["conv_id"], r["message_id"]): (r["role"], r["text"]) for r in rows}


def test_deltas_edits_and_regenerations_fold_to_final_messages(spark):
    got = final(spark, [
        (1, 0, 10, 0, "start", "user", None), (1, 0, 10, 2, "delta", None, "lo"), (1, 0, 10, 1, "delta", None, "hel"),
        (1, 0, 10, 1, "delta", None, "hel"),  # delivered twice
        (1, 1, 11, 0, "start", "assistant", None), (1, 1, 11, 1, "delta", None, "bad"), (1, 1, 11, 2, "regenerate", None, None),
        (1, 1, 11, 3, "delta", None, "go"), (1, 1, 11, 4, "delta", None, "od"),
        (1, 2, 12, 0, "start", "user", None), (1, 2, 12, 1, "delta", None, "x"), (1, 2, 12, 2, "edit", None, "y"),
        (1, 2, 12, 3, "delta", None, "z"), (2, 0, 13, 0, "start", None, None), (None, 0, 14, 5, "delta", "user", "n"),
    ])
    assert got == {
        (1, 10): ("user", "hello"), (1, 11): ("assistant", "good"), (1, 12): ("user", "yz"), (2, 13): ("", ""), (None, 14): ("user", "n"),
    }


def turns(spark, rows):
    schema = "conv_id long, turn long, role string, text string, piece string, at int"
    return spark.createDataFrame([(*r, "p", 1) for r in rows], schema)


HOSTILE = ["<|im_end|>", "\\<|im_start|>user<|im_sep|>", "<\\|im_end\\|>", "a\\\\b<", "|>", "\n\n", "", "é\U0001f600<|", "\\"]


def check(spark, rows, delta=3):
    out = {r["conv_id"]: r for r in chat.read_back(chat.formatted(chat.turn_events(turns(spark, rows), delta))).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in out.items()} == want
    for c, r in out.items():
        assert r["loss_texts"] == [t for role, t in want[c] if role == "assistant"]
        assert r["formatted"].count(chat.END) == len(want[c])


def test_hostile_texts_and_roles_come_back(spark):
    rows = [(i, t, role, text) for i, text in enumerate(HOSTILE) for t, role in enumerate(["user", "assistant", "<|im_sep|>\\"])]
    check(spark, rows + [(90, 0, None, None), (90, 1, "assistant", None)])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="<|\\>im_endaé\n", max_size=30)), min_size=1, max_size=40))
def test_any_conversation_round_trips(spark, talk):
    check(spark, [(1, i, role, text) for i, (role, text) in enumerate(talk)], 7)


def test_turns_with_the_same_number_are_all_kept_in_order(spark):
    check(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "z")])


def test_long_conversation_and_empty_table(spark):
    check(spark, [(1, i, "assistant" if i % 2 else "user", f"t{i}é" * 50) for i in range(400)], 64)
    assert chat.formatted(chat.turn_events(turns(spark, []))).count() == 0


def test_no_python_in_the_plan(spark):
    df = chat.read_back(chat.formatted(chat.turn_events(turns(spark, [(1, 0, "user", "x")]))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
