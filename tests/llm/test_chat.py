"""Role repair against exhaustive search, and stretches against one pass."""

from __future__ import annotations

import random
from itertools import product

import pytest

from lakeworks.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string, states long"


def turns(spark, conversations):
    rows = [(c, k, role, f"{role}{k}", "x", 1) for c, roles in conversations.items() for k, role in enumerate(roles)]
    return spark.createDataFrame(rows, SCHEMA)


def cheapest(roles):
    """Least cost over every labelling and every choice of merging or opening a turn."""
    form, best = chat.Format(), None
    for labels in product(("system", "user", "assistant"), repeat=len(roles)):
        for merges in product((False, True), repeat=len(roles)):
            cost, state = 0, "start"
            for role, label, merge in zip(roles, labels, merges):
                cost += form.relabel * (role != label)
                if merge:
                    if label != state:
                        break
                    cost += form.merge
                elif label not in chat.LEGAL[state]:
                    if (state, label) not in chat.BRIDGES:
                        break
                    cost += form.insert
                state = label
            else:
                cost += form.insert * len(chat.ENDINGS[state])
                best = cost if best is None else min(best, cost)
    return best


def legal(roles):
    state = "start"
    for role in roles:
        if role not in chat.LEGAL[state]:
            return False
        state = role
    return state == "assistant"


def test_costs_are_least_and_sequences_legal(spark):
    rng = random.Random(3)
    menu = ["system", "user", "assistant", "tool"]
    conversations = {c: [rng.choice(menu) for _ in range(rng.randint(1, 4))] for c in range(60)}
    found = chat.repaired(turns(spark, conversations)).toPandas().sort_values(["conv_id", "piece"])
    for c, roles in conversations.items():
        own = found[found.conv_id == c]
        assert own.cost.sum() == cheapest(roles)
        assert legal(own.drop_duplicates("out_turn").role.tolist())
        assert list(own.piece) == list(range(len(own)))
        assert own.source_turn.dropna().tolist() == list(range(len(roles)))


@pytest.mark.parametrize("long", [1, 3, 7])
def test_stretches_give_the_same_as_one_pass(spark, long):
    rng = random.Random(5)
    conversations = {c: [rng.choice(["system", "user", "assistant"]) for _ in range(n)] for c, n in enumerate((40, 2, 13))}
    given = turns(spark, conversations)
    one = {(r.conv_id, r.piece): r for r in chat.repaired(given).collect()}
    cut = {(r.conv_id, r.piece): r for r in chat.repaired(given, long=long).collect()}
    assert {k: tuple(v) for k, v in cut.items()} == {k: tuple(v) for k, v in one.items()}


@pytest.mark.parametrize("long", [2, 5])
def test_turns_of_one_number_are_cut_apart(spark, long):
    rng = random.Random(9)
    roles = ["system", "user", "assistant", "tool", None]
    rows = [(c, n, rng.choice(roles), rng.choice(["a", "b", None])) for c in (None, 7) for n in [None] * 30 + [1] * 5 + [2]]
    rows += [(8, None, "user", "same")] * 40 + [(9, 1, "user", "short")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one = sorted(map(str, chat.repaired(given).collect()))
    assert sorted(map(str, chat.repaired(given, long=long).collect())) == one
    plain = given.selectExpr("conv_id as conv", "turn", "role", "text", "xxhash64(text) as code")
    found, any_cut = chat._stretched(plain, long)
    assert any_cut and found.count() == len(rows)
    assert found.groupBy("conv", "stretch").count().agg({"count": "max"}).first()[0] <= long


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, " USER ", "hi"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "assistant", "b")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.rendered(chat.repaired(given)).collect()}
    assert found[1].text == "<|user|>\n<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\na\n\na<|end|>\n<|assistant|>\n<|end|>\n"
    assert found[1].cost == 2 + 1 + 2
    assert found[None].text.endswith("<|end|>\n")
    assert chat.repaired(given.limit(0)).count() == 0
