"""Chat repair against a shortest-path search over single edits."""

import heapq
import random

import pytest

from stratum.llm import chat_repair as C

LEGAL = {(None, "system"), (None, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}


def cheapest(roles):
    """Dijkstra over (turns used, last role)."""
    queue, done = [(0.0, 0, "")], set()
    while queue:
        cost, i, last = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(roles) and last == "assistant":
            return cost
        for to in C.ROLES:
            legal = (last or None, to) in LEGAL
            if legal:
                heapq.heappush(queue, (cost + 3, i, to))
            if i < len(roles):
                change = 0 if roles[i] == to else 2
                if legal:
                    heapq.heappush(queue, (cost + change, i + 1, to))
                if last == to:
                    heapq.heappush(queue, (cost + change + 1, i + 1, to))
    raise AssertionError


def sequence(rows):
    out = []
    for r in rows:
        out += r["empty_before"]
        if "merge" in r["action"]:
            assert out[-1] == r["role"]
        else:
            out.append(r["role"])
        out += r["empty_after"]
    return out


def run(spark, turns, **how):
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, cost string, chunk string")
    by = {}
    for r in C.repair(df, **how).collect():
        by.setdefault(r["conv_id"], []).append(r.asDict())
    return {k: sorted(v, key=lambda r: r["nth"]) for k, v in by.items()}


@pytest.mark.parametrize("chunk", [4096, 3])
def test_least_cost_and_legal(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rng = random.Random(chunk)
    kinds = ["system", "user", "assistant", "user", "assistant", None, "tool", ""]
    turns = [(c, t, rng.choice(kinds), rng.choice([None, "", f"text {t}"]), "x", "y") for c in [None, *range(30)] for t in range(rng.randint(1, 14))]
    turns += [(99, t, ("user", "assistant")[t % 2], f"t{t}", "x", "y") for t in range(200)]  # one long legal conversation
    got = run(spark, turns)
    for conv in {t[0] for t in turns}:
        given = sorted((t for t in turns if t[0] == conv), key=lambda t: t[1])
        rows = got[conv]
        assert [r["turn"] for r in rows] == [t[1] for t in given] and [r["nth"] for r in rows] == list(range(len(given)))
        assert sum(r["cost"] for r in rows) == cheapest([t[2] if t[2] in C.ROLES else None for t in given])
        steps = sequence(rows)
        assert steps[-1] == "assistant" and all(p in LEGAL for p in zip([None, *steps[:-1]], steps, strict=True))
    assert {r["action"] for r in got[99]} == {"keep"}
    assert "".join(r["rendered"] for r in got[99][:2]) == "<|user|>\nt0\n<|assistant|>\nt1"


def test_rendering_of_merges_and_empty_turns(spark):
    turns = [(1, 0, "assistant", "a", "", ""), (1, 1, "assistant", "b", "", ""), (2, 0, "user", "hi", "", ""), (2, 0, "user", "hi", "", "")]
    got = run(spark, turns)
    assert "".join(r["rendered"] for r in got[1]) == "<|user|>\na\n<|assistant|>\nb\n"  # relabelling beats an empty turn and a merge
    assert [r["action"] for r in got[1]] == ["relabel", "keep"]
    assert "".join(r["rendered"] for r in got[2]) in ("<|user|>\nhi\n<|assistant|>\nhi\n",)


def test_empty_table(spark):
    assert run(spark, []) == {}
