import random
import re
from itertools import product

import pytest

from tidegrid.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def legal(roles):
    """[system] (user assistant)+"""
    body = roles[1:] if roles and roles[0] == "system" else roles
    return len(body) >= 2 and len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def least_cost(roles):
    """Every way to merge, relabel and complete the turns, without the automaton."""
    best = None
    for labels in product(C.ROLES, repeat=len(roles)):
        change = sum(
            0 if a == b else C.NAME if a not in C.ROLES else C.RELABEL for a, b in zip(roles, labels, strict=True)
        )
        for joins in product((False, True), repeat=len(roles) - 1):
            if any(j and labels[i] != labels[i + 1] for i, j in enumerate(joins)):
                continue
            turns = [labels[0], *(b for b, j in zip(labels[1:], joins, strict=True) if not j)]
            inserts = insertions(turns)
            if inserts is not None:
                cost = change + C.MERGE * sum(joins) + C.INSERT * inserts
                best = cost if best is None else min(best, cost)
    return best


def insertions(turns):
    """Fewest turns to add so that the sequence is legal."""
    for n in range(2 * len(turns) + 3):
        for system in ((), ("system",)):
            total = len(turns) + n - len(system)
            if total < 2 or total % 2:
                continue
            whole = [*system, *("user", "assistant") * (total // 2)]
            rest = iter(whole)
            if all(t in rest for t in turns):
                return n
    return None


def rendered_roles(text):
    return re.findall(r"<\|(system|user|assistant)\|>", text)


def render(roles, texts=None):
    kinds = [C.role_class(r) for r in roles]
    return C.fragments(kinds, texts or [f"t{i}" for i in range(len(roles))])


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_cost_is_the_least_and_the_result_legal(n):
    for roles in product((*C.ROLES, "tool"), repeat=n):
        pieces = render(roles)
        text = "".join(p[0] for p in pieces)
        assert legal(rendered_roles(text)), roles
        assert sum(p[1] for p in pieces) == least_cost(roles), roles
        cost = sum(C.MERGE * p[2] + C.INSERT * p[4] for p in pieces) + sum(
            p[3] * (C.NAME if r == "tool" else C.RELABEL) for p, r in zip(pieces, roles, strict=True)
        )
        assert cost == sum(p[1] for p in pieces)
        assert sum(p[5] for p in pieces) == len(rendered_roles(text)) == text.count(C.CLOSE)
        assert re.findall(r"t\d", text) == [f"t{i}" for i in range(n)]


def test_rendering():
    pieces = render(["USER ", "user", "assistant"], ["a", "b", None])
    assert "".join(p[0] for p in pieces) == "<|user|>\na\n\nb<|end|>\n<|assistant|>\n<|end|>\n"
    pieces = render(["assistant"], ["x"])
    assert "".join(p[0] for p in pieces) == "<|user|>\n<|end|>\n<|assistant|>\nx<|end|>\n"


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(40):
        for turn in range(rng.choice([1, 2, 3, 8])):
            rows.append((conv, turn, rng.choice([*C.ROLES, "user", "assistant", "Tool", None, " User"]), f"c{conv}t{turn}"))
    for turn in range(3000):
        rows.append((1000, turn, rng.choice(["user", "assistant", "system", "x"]), f"big{turn}"))
    return rows


def test_conversations_over_many_tasks_equal_one_pass(spark):
    rows = conversations()
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    got = C.render_chats(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.part)):
        by.setdefault(r.conv_id, []).append(r)
    assert len(by[1000]) == 3 and [r.n_turns for r in by[1000]] == [1024, 1024, 952]
    for conv, parts in by.items():
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        pieces = C.fragments([C.role_class(r[2]) for r in mine], [r[3] for r in mine])
        assert "".join(r.text for r in parts) == "".join(p[0] for p in pieces)
        assert legal(rendered_roles("".join(r.text for r in parts)))
        for i, name in enumerate(("cost", "merges", "relabels", "inserts", "n_rendered"), 1):
            assert sum(r[name] for r in parts) == sum(p[i] for p in pieces)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "a"), (None, None, "user", None), (None, 1, "user", "a"), (5, 0, None, ""),
        (6, 0, "user", "x" * 300_000), (6, 1, "assistant", None),
    ]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", _at int, part string")
    got = {r.conv_id: r for r in C.render_chats(docs).collect()}
    assert set(got) == {None, 5, 6}
    assert got[None].text == "<|user|>\n\n\na<|end|>\n<|assistant|>\na<|end|>\n"
    assert (got[None].merges, got[None].relabels, got[None].cost) == (1, 1, C.MERGE + C.RELABEL)
    assert (got[5].cost, got[5].relabels, got[5].inserts) == (C.NAME + C.INSERT, 1, 1)
    assert got[6].cost == 0 and len(got[6].text) > 300_000
    assert C.render_chats(docs.limit(0)).count() == 0
