"""Preference formatting against plain Python, and its defined cases."""

import random

from kiln.llm import chat

TURNS = "pair_id bigint, side string, turn bigint, role string, text string, prompt string"


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def mask(turns):
    out, at = [], 0
    for r, t in turns:
        begin = at + len(f"<|im_start|>{r}\n")
        at = begin + len(t) + len("<|im_end|>\n")
        if r == "assistant":
            out.append(f"{begin}:{at}")
    return ",".join(out)


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    c, r = chosen[n:], rejected[n:]
    return n, render(chosen[:n]), render(c), render(r), mask(c), mask(r)


def run(spark, pairs):
    rows = [(k, side, i, r, t, "x") for k, sides in pairs.items() for side, turns in zip(("chosen", "rejected"), sides) for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    out = chat.format_preferences(spark.createDataFrame(rows, TURNS))
    return {r.pair_id: tuple(r)[1:] for r in out.collect()}


def test_random_pairs(spark):
    rng = random.Random(7)
    turn = lambda: (rng.choice(["user", "assistant", "system"]), rng.choice(["a", "é𝒳", "", "long " * 50]))
    pairs = {}
    for k in range(150):
        common = [turn() for _ in range(rng.randint(0, 5))]
        pairs[k] = (common + [turn() for _ in range(rng.randint(0, 3))], common + [turn() for _ in range(rng.randint(0, 3))])
    pairs = {k: v for k, v in pairs.items() if v[0] or v[1]}
    assert run(spark, pairs) == {k: brute(*v) for k, v in pairs.items()}


def test_defined_cases(spark):
    rows = [(1, "chosen", 0, None, None, ""), (1, "rejected", 0, "", "", ""), (1, "chosen", 1, "assistant", "x", ""),
            (2, "chosen", None, "user", "first", ""), (2, "chosen", 0, "user", "second", ""), (3, "rejected", 0, "assistant", "only", ""),
            (4, "chosen", 0, "user", "same", ""), (4, "rejected", 0, "user", "same", ""),
            (5, "chosen", 0, "user", "twice", ""), (5, "chosen", 0, "user", "twice", "")]
    got = {r.pair_id: r for r in chat.format_preferences(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[1].n_prompt_turns == 1 and got[1].chosen_mask == "22:34" and got[1].rejected == ""
    assert got[2].prompt == "" and got[2].chosen.index("first") < got[2].chosen.index("second")
    assert got[3].chosen == "" and got[3].rejected_mask == "22:37"
    assert (got[4].n_prompt_turns, got[4].chosen, got[4].rejected) == (1, "", "")
    assert got[5].chosen.count("twice") == 2
    assert chat.format_preferences(spark.createDataFrame([], TURNS)).count() == 0


def test_pairs_from_conversations(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, pair_id string"
    rows = [(0, 0, "user", "q", "z"), (0, 1, "assistant", "good", "z"), (1, 0, "user", "other", "z"), (1, 1, "assistant", "bad", "z"),
            (4, 0, "user", "alone", "z"), (None, 0, "user", "no id", "z")]
    got = {r.pair_id: r for r in chat.format_preferences(chat.preference_turns(spark.createDataFrame(rows, schema))).collect()}
    assert set(got) == {0, 1, 4}
    assert (got[0].prompt, got[0].chosen, got[0].rejected) == (render([("user", "q")]), render([("assistant", "good")]), render([("assistant", "bad")]))
    assert got[4].chosen == render([("user", "alone")]) and got[4].rejected == "" and got[4].n_prompt_turns == 0


def test_a_shared_last_turn_number(spark):
    """Two rows with the last number: one of them, by role and text, is the last."""
    rows = [(0, 1, "user", "q"), (0, 2, "assistant", "a"), (0, 2, "assistant", "b"), (1, 1, "user", "q"), (1, 2, "assistant", "z"),
            (None, 1, "user", "lost"), (2, None, "user", None), (2, 1, None, "x" * 100_000)]
    turns = chat.preference_turns(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).collect()
    sides = {}
    for t in sorted(turns, key=lambda t: t.turn):
        sides.setdefault((t.pair_id, t.side), []).append((t.role, t.text))
    assert sides[0, "chosen"] == [("user", "q"), ("assistant", "a"), ("assistant", "b")]
    assert sides[0, "rejected"] == [("user", "q"), ("assistant", "a"), ("assistant", "z")]
    assert sides[1, "rejected"] == [("user", "q"), ("assistant", "b")]
    assert sides[2, "chosen"] == [("user", ""), ("", "x" * 100_000)] and sides[2, "rejected"] == [("user", "")]
    assert {k[0] for k in sides} == {0, 1, 2}
