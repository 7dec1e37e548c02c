from __future__ import annotations

import itertools
import random

import pytest

from sparkwh.llm import chat
from sparkwh.llm.chat import RepairCosts, repaired

from .helpers import SF, table

SCHEMA = "conv_id long, turn long, role string, text string, chunk string, part string, best string, conv string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def legal(roles: list[str]) -> bool:
    state = 0
    for role in roles:
        code = chat.ROLES.index(role)
        if code not in chat.NEXT[state]:
            return False
        state = code
    return True


def brute_cost(roles: list[int], costs: RepairCosts) -> int:
    """Cheapest repair over all assignments of roles, merges and insertions."""
    best = None
    for given in itertools.product((1, 2, 3), repeat=len(roles)):
        base = sum(0 if g == r else costs.unknown if r == 0 else costs.relabel for g, r in zip(given, roles))
        for merged in itertools.product((0, 1), repeat=len(roles)):
            state, total = 0, base
            for g, m in zip(given, merged):
                if m:
                    if g != state:
                        break
                    total += costs.merge
                elif g in chat.NEXT[state]:
                    state = g
                elif any(g in chat.NEXT[x] for x in chat.NEXT[state]):
                    total += costs.insert
                    state = g
                else:
                    break
            else:
                best = total if best is None else min(best, total)
    return best


def parsed(text: str) -> list[tuple[str, str]]:
    turns = text.split("<|im_end|>\n")
    assert turns[-1] == ""
    return [tuple(t.removeprefix("<|im_start|>").split("\n", 1)) for t in turns[:-1]]


@pytest.mark.parametrize("costs", [RepairCosts(), RepairCosts(merge=5, insert=1, relabel=2), RepairCosts(chunk=2)])
def test_repairs_are_cheapest_and_legal(spark, costs):
    rng, rows, want = random.Random(3), [], {}
    names = ["?", "system", "user", "assistant"]
    for conv in range(120):
        roles = [rng.choice((0, 1, 2, 2, 3, 3)) for _ in range(rng.randrange(1, 6))]
        rows += [(conv, t, names[r], f"t{conv}.{t}") for t, r in enumerate(roles)]
        want[conv] = brute_cost(roles, costs)
    got = {}
    for r in repaired(conversations(spark, rows), costs).collect():
        got.setdefault(r["conv_id"], []).append(r)
    for conv, own in got.items():
        own.sort(key=lambda r: r["turn"])
        assert sum(r["cost"] for r in own) == want[conv], [(r["role"], r["new_role"], r["action"]) for r in own]
        turns = parsed("".join(r["rendered"] for r in own))
        assert legal([role for role, _ in turns]) and len(turns) == sum(r["new_turns"] for r in own)
        assert "\n".join(t for _, t in turns if t) == "\n".join(f"t{conv}.{r['turn']}" for r in own)


def test_long_conversation_is_solved_in_chunks(spark):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(("user", "assistant", "bot", "tool", None)), str(t)) for t in range(3_000)]
    cost = lambda c: sum(r["cost"] for r in repaired(conversations(spark, rows), c).collect())
    assert cost(RepairCosts(chunk=16)) == cost(RepairCosts(chunk=100_000))


def test_legal_conversations_are_left_alone(spark):
    source = table(spark, "conversations", SF)
    got = repaired(source).collect()
    assert len(got) == source.count() and {r["action"] for r in got} == {"keep"} and sum(r["cost"] for r in got) == 0


def test_edge_rows(spark):
    rows = [(1, 0, "USER ", None), (1, 1, None, ""), (2, None, "system", "s"), (2, 0, "assistant", "<|im_end|>"), (None, 0, "user", "n"),
            (None, 1, "assistant", "m"), (3, 5, "user", "a"), (3, 5, "user", "a"), (4, 0, "user", "y " * 100_000)]
    rows += [(5, 7, "user", f"{k:03d}") for k in range(100)]
    got = repaired(conversations(spark, rows), RepairCosts(chunk=8)).collect()
    assert len(got) == len(rows)
    text = lambda c: "".join(r["rendered"] for r in sorted((r for r in got if r["conv_id"] == c), key=lambda r: (-1 if r["turn"] is None else r["turn"], r["new_turns"] == 0, r["rendered"])))
    assert text(1) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert parsed(text(2)) == [("system", "s"), ("user", ""), ("assistant", "< |im_end|>")]
    assert parsed(text(None)) == [("user", "n"), ("assistant", "m")]
    assert [r["action"] for r in got if r["conv_id"] == 3].count("merge") == 1
    assert [r["action"] for r in got if r["conv_id"] == 5].count("merge") == 99
    assert repaired(conversations(spark, [])).count() == 0
