"""Conversation repair against all edits, and against a plain dynamic program over strings."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from ponloom.llm import turns

GOOD = re.compile(r"(s?(ua)+)?")


def marked(rows):
    """Turns in order as (number, role, text, must go, truncated), with the counts of faults."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, out, counts = set(), [], dict(blank=0, duplicate=0, truncated=0, illegal=0)
    for i, (n, role, text) in enumerate(rows):
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        counts["illegal"] += i > 0 and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        out.append((n, role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    numbers = {r[0] for r in rows if r[0] is not None}
    counts["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return out, counts


def all_edits(rows):
    """Cheapest edits of all with at most two insertions in a row."""
    fill = [("", []), *[("I", [r]) for r in ("user", "assistant")], *[("II", [a, b]) for a in ("user", "assistant") for b in ("user", "assistant")]]
    choices = []
    for _, role, text, must_go, truncated in rows:
        now = [("D", [], 2)]
        if not must_go:
            stay = 5 * truncated
            now += [("K", [(role, text)], stay), ("R", [("user", text)], stay + 1), ("R", [("assistant", text)], stay + 1)]
        choices.append(now)
    best = None
    for picked in itertools.product(*choices):
        for gaps in itertools.product(fill, repeat=len(rows) + 1):
            cost = sum(p[2] for p in picked) + 5 * sum(len(g[0]) for g in gaps)
            if best is not None and cost > best[0]:
                continue
            audit, made = gaps[0][0], [(r, "") for r in gaps[0][1]]
            for (letter, turn, _), (more, roles) in zip(picked, gaps[1:]):
                audit += letter + more
                made += turn + [(r, "") for r in roles]
            if all(r for r, _ in made) and GOOD.fullmatch("".join(r[0] for r, _ in made)):
                best = min(best or (cost, audit, made), (cost, audit, made))
    return best


def by_states(rows):
    """The same by a dynamic program that holds whole strings."""
    def put(states, key, found):
        if key not in states or found < states[key]:
            states[key] = found

    follow = {"": "us", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for at, (cost, audit, made) in list(states.items()):
                for r in follow[at].replace("s", ""):
                    put(states, r, (cost + 5, audit + "I", made + [(names[r], "")]))

    states = {"": (0, "", [])}
    for _, role, text, must_go, truncated in rows:
        inserted(states)
        after = {}
        for at, (cost, audit, made) in states.items():
            put(after, at, (cost + 2, audit + "D", made))
            if must_go:
                continue
            for r in follow[at]:
                if role[:1] == r:
                    put(after, r, (cost + 5 * truncated, audit + "K", made + [(role, text)]))
                elif r != "s":
                    put(after, r, (cost + 1 + 5 * truncated, audit + "R", made + [(names[r], text)]))
        states = after
    inserted(states)
    return min(states[s] for s in ("", "a") if s in states)


def expected(rows):
    turns_, counts = marked(rows)
    cost, audit, made = by_states(turns_)
    return {**counts, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()}


def conversation(rng, n, roles=("system", "user", "assistant", "tool", "", "umpire")):
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(["", " \n", "Yes.", "No", "Why? ", "So!\x0b", "é"])) for _ in range(n)]


def test_the_plain_program_equals_all_edits():
    rng = random.Random(5)
    for _ in range(40):
        rows, _ = marked(conversation(rng, rng.randint(0, 3)))
        assert by_states(rows) == all_edits(rows)


@pytest.mark.parametrize("longest", [2, 4096])
def test_repair_equals_the_plain_program(spark, monkeypatch, longest):
    monkeypatch.setattr(turns, "RUN", longest)
    rng = random.Random(6)
    talks = {i: conversation(rng, rng.randint(1, 25)) for i in range(60)}
    talks[None] = conversation(rng, 8)
    talks[-1] = [(k, ("user", "assistant")[rng.random() < 0.5], f"text {k}." if k % 7 else "cut") for k in range(400)]
    rows = [(i, *r, 1, 9) for i, rs in talks.items() for r in rs]
    data = spark.createDataFrame(rows, "conv long, turn long, role string, text string, copies int, cost int")
    out = {r["conv"]: r.asDict() for r in turns.repair(data).collect()}
    assert len(out) == len(talks)
    for i, talk in talks.items():
        want = expected(talk)
        assert {c: out[i][c] for c in want} == want


def test_a_conversation_over_many_tasks(spark):
    rng = random.Random(7)
    rows = [(0, k, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{k}.", "again", "", f"x{k}"]), rng.choice([1, 1, 2])) for k in range(3000)]
    data = spark.createDataFrame(rows, "conv int, turn long, role string, text string, copies int").repartition(7)
    out = turns.repair(data).collect()
    want = expected([(k, r, t) for _, k, r, t, c in rows for _ in range(c)])
    assert len(out) == 1 and {c: out[0][c] for c in want} == want


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two? Three!") for c in (1, 2, None) for t in (*range(40), None)] + [(9, 1, None, None)]
    data = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "5 AS copies")
    out = {(r["conv"], r["turn"]): r for r in turns.damage(data).collect()}
    kinds = defaultdict(int)
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        kinds[kind] += 1
        r = out[c, t]
        assert r["copies"] == {0: 0, 3: 2}.get(kind, 1)
        assert r["role"] == ("user" if kind == 4 else role or " ")
        assert r["text"] == ("" if kind == 1 else (text or " ").translate(str.maketrans("", "", ".!?")) if kind == 2 else text or " ")
    assert all(kinds[k] for k in range(5))


def test_nothing_left_and_nothing_at_all(spark):
    schema = "conv string, turn long, role string, text string, copies int"
    out = turns.repair(spark.createDataFrame([("a", 1, "user", "Hi.", 0), ("a", 2, "assistant", "Ho.", 0)], schema)).collect()
    assert [r.asDict() for r in out] == [{"conv": "a", **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "",
                                          "repaired_sha256": hashlib.sha256(b"").hexdigest()}]
    assert turns.repair(spark.createDataFrame([], schema)).collect() == []


def test_very_long_text_and_repeated_rows(spark):
    rows = [(1, 0, "user", "word " * 200_000 + ".", 1), (1, 1, "assistant", "Ok.", 1), (1, 1, "assistant", "Ok.", 1)]
    out = turns.repair(spark.createDataFrame(rows, "conv int, turn int, role string, text string, copies int")).collect()[0]
    assert (out["audit"], out["cost"], out["duplicate"]) == ("KKD", 2, 1)


def test_audits_compare_by_their_strings_also_when_hashes_collide(monkeypatch):
    for prime in (turns._PRIME, 3):
        monkeypatch.setattr(turns, "_PRIME", prime)
        audits, rng, nodes = turns.Audits(), random.Random(8), [0]
        for _ in range(400):
            nodes.append(audits.add(rng.choice(nodes[-20:]), rng.choice("DIKR")))
        for a, b in [(rng.choice(nodes), rng.choice(nodes)) for _ in range(2000)]:
            assert audits.less(a, b) == (audits.text(a) < audits.text(b))
            assert (a == b) == (audits.text(a) == audits.text(b))
