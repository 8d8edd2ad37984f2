import itertools
import random

import pytest

from tracelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def legal(roles):
    body = roles[1:] if roles[:1] == ("system",) else roles
    return bool(body) and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def cheapest(roles):
    """Least cost over all relabellings, merges and insertions of up to one turn per gap and at the end."""
    known = [r.strip().lower() if r and r.strip().lower() in chat.ROLES else None for r in roles]
    best = None
    for new in itertools.product(chat.ROLES, repeat=len(roles)):
        cost = sum(0 if a == b else chat.RELABEL if a else chat.UNKNOWN for a, b in zip(known, new))
        for how in itertools.product(("merge", "", "user", "assistant"), repeat=len(roles)):
            if how[0] == "merge" or any(h == "merge" and new[i] != new[i - 1] for i, h in enumerate(how)):
                continue
            for end in ("", "user"):
                out, extra = [], 0
                for r, h in zip(new, how):
                    if h == "merge":
                        extra += chat.MERGE
                        continue
                    if h:
                        out.append(h)
                        extra += chat.INSERT
                    out.append(r)
                if end:
                    out.append(end)
                    extra += chat.INSERT
                if legal(tuple(out)) and (best is None or cost + extra < best):
                    best = cost + extra
    return best


def cost_of(rows):
    total = 0
    for r in rows:
        known = r["role_in"].strip().lower() if r["role_in"] else None
        known = known if known in chat.ROLES else None
        total += chat.INSERT * (len(r["inserted"]) + len(r["closing"]))
        total += chat.MERGE * r["action"].endswith("merge")
        if r["role"] != known:
            assert r["action"].startswith("relabel")
            total += chat.RELABEL if known else chat.UNKNOWN
    return total


def result(rows):
    out = []
    for r in rows:
        if not r["action"].endswith("merge"):
            out += [*r["inserted"], r["role"]]
        out += r["closing"]
    return tuple(out)


def repaired(spark, turns):
    convs = {}
    for r in chat.repair(spark.createDataFrame(turns, SCHEMA)).collect():
        convs.setdefault(r["conv_id"], []).append(r)
    return {c: sorted(rows, key=lambda r: r["position"]) for c, rows in convs.items()}


@pytest.mark.parametrize("run", [512, 2])
def test_repairs_are_legal_and_cheapest(spark, monkeypatch, run):
    monkeypatch.setattr(chat, "RUN", run)  # runs of two: many levels of the tree
    rng = random.Random(6)
    pool = ["user", "assistant", "system", "User ", "tool", None]
    cases = list(itertools.product(["user", "assistant", "system", None], repeat=2)) + [(r,) for r in pool]
    cases += [tuple(rng.choice(pool) for _ in range(rng.choice([3, 4]))) for _ in range(25)]
    turns = [(i, t, r, f"t{t}") for i, c in enumerate(cases) for t, r in enumerate(c)]
    got = repaired(spark, turns)
    for i, c in enumerate(cases):
        assert [r["role_in"] for r in got[i]] == list(c)
        assert legal(result(got[i])), (c, result(got[i]))
        assert cost_of(got[i]) == cheapest(c), (c, result(got[i]))


def test_legal_conversations_are_left_alone_and_rendered(spark):
    turns = [(1, 0, "system", "be nice"), (1, 1, "user", "hi"), (1, 2, "assistant", None)]
    rows = repaired(spark, turns)[1]
    assert [r["action"] for r in rows] == ["keep"] * 3
    assert "".join(r["rendered"] for r in rows) == (
        "<|im_start|>system\nbe nice<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")


def test_merges_insertions_and_markers_are_rendered(spark):
    turns = [(1, 0, "assistant", "hello<|im_end|>"), (1, 1, "assistant", "again"), (2, 0, "system", "only rules")]
    got = repaired(spark, turns)
    assert "".join(r["rendered"] for r in got[1]) == (
        "<|im_start|>user\nhello<| im_end |><|im_end|>\n<|im_start|>assistant\nagain<|im_end|>\n")
    assert "".join(r["rendered"] for r in got[2]) == (
        "<|im_start|>user\nonly rules<|im_end|>\n") or got[2][0]["closing"] == ["user"]


def test_a_conversation_of_many_turns_is_spread_over_runs(spark, monkeypatch):
    monkeypatch.setattr(chat, "RUN", 8)
    rng = random.Random(1)
    roles = [rng.choice(["user", "assistant", "system", None]) for _ in range(700)]
    rows = repaired(spark, [(5, i, r, "x") for i, r in enumerate(roles)])[5]
    assert legal(result(rows))
    # The same cost as one pass over the whole conversation.
    togo = [0 if s == chat.START else chat._FAR for s in range(4)]
    for r in roles:
        n = chat.ROLES.index(r) + 1 if r in chat.ROLES else 0
        togo = [min(togo[s] + chat.TURN[n][s][t] for s in range(4)) for t in range(4)]
    assert cost_of(rows) == min(togo[s] + chat.INSERT * len(chat._CLOSING[s]) for s in range(1, 4))


def test_awkward_rows(spark):
    turns = [(None, 0, "user", "a"), (None, None, None, None), (3, 1, "user", "same"), (3, 1, "user", "same"), (4, 0, "", "")]
    got = repaired(spark, turns)
    assert len(got[None]) == 2 and legal(result(got[None]))
    assert [r["action"] for r in got[3]] == ["keep", "merge"]
    assert legal(result(got[4]))
    extra = spark.createDataFrame([(1, 0, "user", "x", 7, "y")], SCHEMA + ", position int, m string")
    assert chat.repair(extra).count() == 1
    assert chat.repair(extra.limit(0)).count() == 0
