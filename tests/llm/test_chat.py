import random
from itertools import product

import numpy as np
import pytest

from hirelens.llm import chat

COSTS = chat.Costs()
LEGAL = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def is_legal(roles):
    return all(b in LEGAL[a] for a, b in zip([None, *roles], roles)) and (not roles or roles[-1] == "assistant")


def cheapest(roles):
    """By trying all ways to merge and relabel, and all short runs of empty turns between."""
    best = np.inf
    for merges in product((False, True), repeat=len(roles)):
        if merges and merges[0]:
            continue
        for names in product(chat.ROLES, repeat=len(roles)):
            price, turns = 0.0, []
            for m, name, role in zip(merges, names, roles):
                if m and turns[-1] != name:
                    break
                changed = 0 if name == role else COSTS.relabel if role in chat.ROLES else COSTS.foreign
                price += changed + (COSTS.merge if m else 0)
                if not m:
                    turns.append(name)
            else:
                price += COSTS.insert * inserted(turns)
                best = min(best, price)
    return best


def inserted(turns):
    """Fewest turns to insert, before each turn and at the end."""
    total, before = 0, None
    for t in [*turns, "end"]:
        total += next(n for n in range(4) for way in product(chat.ROLES, repeat=n)
                      if is_legal_step([before, *way], t)) if is_possible(before, t) else np.inf
        before = t
    return total


def is_possible(before, target):
    """Nothing leads to a system turn but the beginning."""
    return target != "system" or before is None


def is_legal_step(path, target):
    ok = all(b in LEGAL[a] for a, b in zip(path, path[1:]))
    return ok and (path[-1] == "assistant" if target == "end" else target in LEGAL[path[-1]])


def repaired(spark, some, partitions=None):
    df = spark.createDataFrame(some, "conv_id long, turn long, role string, text string")
    return sorted(chat.repair(df.repartition(3)).collect(), key=lambda r: (r.conv_id is not None, r.conv_id, r.place))


@pytest.mark.parametrize("seed", range(3))
def test_cost_is_least(spark, seed):
    rng = random.Random(seed)
    convs = [[rng.choice(["system", "user", "assistant", "tool", None]) for _ in range(rng.randint(1, 4))] for _ in range(25)]
    rows = repaired(spark, [(c, t, role, f"{c}.{t}") for c, roles in enumerate(convs) for t, role in enumerate(roles)])
    for c, roles in enumerate(convs):
        own = [r for r in rows if r.conv_id == c]
        assert [r.place for r in own] == list(range(len(roles)))
        assert sum(r.cost for r in own) == cheapest(roles), roles
        rendered = "".join(r.fragment for r in own)
        turns = [x.split("<|im_end|>")[0].split("\n", 1) for x in rendered.split("<|im_start|>")[1:]]
        assert is_legal([t[0] for t in turns]) and rendered.endswith("<|im_end|>\n")
        assert [x for t in turns for x in t[1].split("\n") if x] == [f"{c}.{t}" for t in range(len(roles))]


def test_legal_conversations_stay(spark):
    rows = repaired(spark, [(1, t, r, "x") for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])])
    assert all(r.cost == 0 and r.action == "keep" and r.inserted == "" for r in rows)
    assert "".join(r.fragment for r in rows) == "".join(
        f"<|im_start|>{r}\nx<|im_end|>\n" for r in ["system", "user", "assistant", "user", "assistant"])


def test_a_long_conversation_over_many_blocks(spark):
    """Cut into blocks it comes out as in one piece."""
    rng = random.Random(5)
    some = [(c, t, rng.choice(["user", "assistant", "system", "bot", "user", "assistant"]), f"{t}") for c, n in
            [(1, 3), (2, 400), (3, 1), (None, 150), (4, 2)] for t in range(n)]
    many = repaired(spark, some)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = repaired(spark, some)
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        more = repaired(spark, some)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert many == one == more and len(one) == len(some)


def test_awkward_rows(spark):
    rows = repaired(spark, [(1, None, "user", None), (1, 0, None, ""), (1, 0, None, ""), (None, None, None, None), (2, 1, "user", "x" * 100_000)])
    assert len(rows) == 5 and rows[0].conv_id is None
    assert [r.turn for r in rows if r.conv_id == 1] == [0, 0, None]
    assert repaired(spark, []) == []
    df = spark.createDataFrame([(1, 0, "user", "a", "b", 3)], "conv_id long, turn long, role string, text string, place string, block int")
    assert [r.role for r in chat.repair(df).collect()] == ["user"]
