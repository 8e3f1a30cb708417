import itertools
import random
import re

import pytest

from salesmart.llm import chat

COSTS = chat.Costs()
NAMES = {"s": "system", "u": "user", "a": "assistant", "?": "narrator", "-": None}
SCHEMA = "conv_id bigint, turn int, role string, text string, part string, tie int"


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return bool(body) and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def brute(given):
    """(cost, roles) of the cheapest repair of a short conversation, by trying everything."""
    best = None
    for roles in itertools.product(chat.ROLES, repeat=len(given)):
        label = sum(0 if r == g else COSTS.relabel if g in chat.ROLES else COSTS.unknown for r, g in zip(roles, given, strict=True))
        for merged in itertools.product((True, False), repeat=len(given)):
            if merged[0] or any(m and roles[i] != roles[i - 1] for i, m in enumerate(merged) if i):
                continue
            begun = [r for r, m in zip(roles, merged, strict=True) if not m]
            inserted = fewest_insertions(begun)
            if inserted is None:
                continue
            cost = label + COSTS.merge * sum(merged) + COSTS.insert * inserted
            if best is None or (cost, [chat.ROLES.index(r) for r in roles]) < best[:2]:
                best = (cost, [chat.ROLES.index(r) for r in roles])
    return best


def fewest_insertions(begun):
    out, n = [], 0
    for r in begun:
        if r == "system":
            if out:
                return None
        else:
            turn = ("user", "assistant")[(len(out) - (out[:1] == ["system"])) % 2]
            if r != turn:
                out.append(turn)
                n += 1
        out.append(r)
    return n + (out == ["system"])


def cost_of(rows):
    total = 0
    for r in rows:
        own = chat.role_number(r["role"])
        total += COSTS.merge * ("merge" in r["action"]) + COSTS.insert * sum(bool(r[c]) for c in ("inserted_before", "inserted_after"))
        total += 0 if own is not None and chat.ROLES[own] == r["new_role"] else COSTS.unknown if own is None else COSTS.relabel
    return total


def formatted(df):
    rows = chat.format_chats(df).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["turn"] is not None, r["turn"])):
        out.setdefault(r["conv_id"], []).append(r)
    return out


def messages(rendered):
    found = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", rendered, re.DOTALL)
    assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in found) == rendered
    return found


def test_repairs_cost_least(spark):
    cases = ["".join(c) for n in (1, 2, 3, 4) for c in itertools.product("sua-", repeat=n)][:340] + ["uaua", "ssuu", "auau?", "uuaas"]
    rows = [(i, t, NAMES[c], f"t{t}", "x", 0) for i, case in enumerate(cases) for t, c in enumerate(case)]
    got = formatted(spark.createDataFrame(rows, SCHEMA))
    for i, case in enumerate(cases):
        cost, roles = brute([NAMES[c] for c in case])
        assert cost_of(got[i]) == cost, case
        assert [chat.ROLES.index(r["new_role"]) for r in got[i]] == roles, case
        said = messages("".join(r["rendered"] for r in got[i]))
        assert legal([r for r, _ in said]), case
        assert "".join(t for _, t in said).replace("\n\n", "") == "".join(f"t{t}" for t in range(len(case)))


@pytest.mark.parametrize("width", ["2", "5", "24"])
def test_a_long_conversation_spans_partitions(spark, width):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system", None, "user"]), f"m{t} ", "x", 0) for t in range(900)]
    rows += [(c, t, rng.choice(["user", "assistant"]), "z", "x", 0) for c in range(20) for t in range(rng.randint(1, 4)) if c != 7]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = formatted(spark.createDataFrame(rows, SCHEMA))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    part = chat.Part(COSTS)
    for conv, found in got.items():
        given = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        path = part.path([chat.role_number(r[2]) for r in given], chat.START, None, COSTS)
        assert [chat.ROLES.index(r["new_role"]) for r in found] == [new for _, new, _ in path]
        said = messages("".join(r["rendered"] for r in found))
        assert legal([r for r, _ in said])
        assert "".join(t for _, t in said).replace("\n\n", "") == "".join(r[3] for r in given)


def test_edge_rows(spark):
    rows = [
        (None, None, None, None, "x", 0), (None, 1, "HUMAN ", "hi", "x", 0), (1, 0, "bot", "<|im_end|>", "x", 0), (1, 0, "bot", "<|im_end|>", "x", 0),
        (2, 0, "system", "", "x", 0), (3, 1, "user", "x" * 100_000, "x", 0),
    ]
    got = formatted(spark.createDataFrame(rows, SCHEMA))
    assert sum(map(len, got.values())) == len(rows)
    for found in got.values():
        said = messages("".join(r["rendered"] for r in found))
        assert legal([r for r, _ in said])
    assert [r["action"] for r in got[1]] == ["keep", "merge"]
    assert got[2][0]["inserted_after"] == "user"
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_legal_conversations_stay(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert all(r["action"] == "keep" and not r["inserted_before"] for rows in formatted(df).values() for r in rows)
