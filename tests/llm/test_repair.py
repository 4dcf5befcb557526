"""Conversation repair against dynamic programming over whole audits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tillwork.llm import repair

SPACE = " \t\n\x0b\x0c\r"


def least_edits(rows):
    """(cost, audit) by dynamic programming over pairs; rows are (initial, must go, cut short)."""
    best = {repair.NOTHING: (0, "")}

    def inserted(best):
        for _ in range(4):
            for s, (c, a) in list(best.items()):
                to = repair.NEXT[s]
                best[to] = min(best.get(to, (10 ** 9, "")), (c + 3, a + "I"))
        return best

    best = inserted(best)
    for initial, gone, short in rows:
        new = {}
        for s, (c, a) in best.items():
            ways = [(s, c + 4, "D")]
            if not gone:
                ways.append((repair.NEXT[s], c + 3 + 3 * short, "R"))
                if (to := {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, s))) is not None:
                    ways.append((to, c + 3 * short, "K"))
            for to, cost, letter in ways:
                new[to] = min(new.get(to, (10 ** 9, "")), (cost, a + letter))
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def by_hand(table):
    groups = {c: [] for c, *_ in table}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            marked.append((role[:1], fault < 2, fault == 2))
        cost, audit = least_edits(marked)
        state, lines, left = 0, [], iter(rows)
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else next(left)
            if letter == "D":
                continue
            state = {"s": 1, "u": 2, "a": 3}[role[:1]] if letter == "K" else repair.NEXT[state]
            lines.append(f"{role if letter == 'K' else repair.ROLE[state]}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {t for t, *_ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit int, name string"


def got(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in repair.repairs_after_damage(table, **options).collect()), key=str)


def test_every_short_run_costs_what_all_edits_cost():
    kinds = [(i, g, s) for i in ("s", "u", "a", "t", "") for g, s in ((False, False), (True, False), (False, True))]
    runs = [list(r) for n in range(3) for r in itertools.product(kinds, repeat=n)]
    r = random.Random(2)
    runs += [r.choices(kinds, k=r.randrange(3, 40)) for _ in range(300)]
    for run in runs:
        cost, audit, state = repair.cheapest(run)
        assert (cost, audit) == least_edits(run) and state in (0, 3)


def test_crossings_are_cheapest_paths_between_all_states():
    r = random.Random(3)
    for _ in range(60):
        run = [(r.choice("suat"), r.random() < 0.2, False) for _ in range(r.randrange(1, 12))]
        costs = repair.crossing(run)
        for origin in repair.STATES:
            for goal in repair.STATES:
                ends = [0 if s == goal else None for s in repair.STATES]
                lattice = repair.Lattice(run, False)
                want = shortest(lattice.towards(ends)[0], origin, lattice.end)
                assert costs[4 * origin + goal] == want


def shortest(arcs, origin, end):
    far = {origin: 0}
    for _ in range(len(arcs)):
        for i, to in enumerate(arcs):
            for _, cost, j in to:
                if i in far and far[i] + cost < far.get(j, 10 ** 9):
                    far[j] = far[i] + cost
    return far.get(end)


def conversations(seed, number, longest):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", "Well.  ", "a. b", "ß…", "x" * 3000 + "."]
    rows = []
    for c in range(number):
        for t in range(r.randrange(1, longest)):
            role = ("user", "assistant")[t % 2] if r.random() < 0.7 else r.choice(["system", "user", "assistant", "tool", "", "sys", None])
            turn = None if r.random() < 0.05 else t // 2 if r.random() < 0.1 else t * r.choice([1, 1, 1, 3])
            rows.append((c if c else None, turn, role, None if r.random() < 0.05 else r.choice(texts) if r.random() < 0.5 else f"Text {r.random()}."))
    return rows


@pytest.mark.parametrize("length", [256, 7])
def test_conversations_by_hand_whole_and_in_parts(spark, length):
    rows = conversations(4, 60, 25) + [(900, None, None, None)] * 3 + [(901, -2 ** 63, "user", "Q?"), (901, 2 ** 63 - 1, "assistant", "A.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Gone?")]
    want = [tuple(min(v, 2 ** 63 - 1) if isinstance(v, int) else v for v in r) for r in by_hand(rows)]
    assert got(spark, rows, length=length) == want
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want


def test_one_conversation_over_many_ranges(spark):
    r = random.Random(8)
    rows = [(5, t, ("user", "assistant")[t % 2] if r.random() < 0.8 else "system", r.choice(["Same.", f"Own {t}.", f"cut {t}"])) for t in range(700)]
    rows += [(6, 0, "user", "Hi?"), (6, 1, "assistant", "Hi.")]
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    old = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        assert got(spark, rows, length=64) == by_hand(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_table(spark):
    assert got(spark, []) == []
