"""Conversation structure repair by an auction for the cheapest path through an edit lattice.

A conversation should be an optional system message and then pairs of user and assistant. The lattice has
a node for every number of rows read and every state of what was written (nothing, system, user,
assistant); arcs keep, rerole or delete the next row, or insert a message, at whole costs. The
auction holds a path from the origin and a price per node: the path's last node either raises its
price to the cheapest continuation and leaves the path (contraction), or the path goes on along
that arc (extension), until it reaches the end. Prices begin at what the rest of the rows costs at
least. At the end they are dual feasible, and every cheapest path consists of tight arcs (price =
cost + next price); among the tight arcs that lead to the end, the trace takes the least initial.

Rows are range-partitioned and sorted by conversation and turn, and packed into segments of bounded
length as they stream by. Conversations of one segment, nearly all, are solved at once. Longer ones
are solved in parts: of each segment, auctions give the cost from every state before it to every state
behind it; a pass from the last segment to the first turns them into the prices at the borders, with
which every segment is traced from each of four states; a pass in order picks the states that
occur, and hashes. These passes stream and hold a few numbers a conversation, so a
conversation may have any share of all rows.

Defined results: null roles and texts are one space, null ids are a conversation of their own; null
turns come first, rows of one turn in the order of role and text, equal rows are neighbours; rows of the
same role and text in one conversation are duplicates of the first; a role counts by its first
character, and any but s, u and a can only be changed or deleted; turns and counts are 64-bit;
a conversation whose rows are all gone has zeros, an empty audit and the hash of the empty text; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.session import written

SPACE = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)  # what may be written after each state by Rerole or Insert
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
RIGHT = {"su", "ua", "au"}
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FINAL = (0, None, None, 0)  # what it costs to end in each state; None: not allowed
SEGMENT, SEGMENT_BYTES = 64, 4 << 20


class Lattice:
    """The arcs of a run of rows. A row is (initial, must go, cut short); ``ends`` are the prices behind it.

    Inserts behind the last row belong to the next run, unless this is the last one.
    """

    def __init__(self, rows: list[tuple[str, bool, bool]], last: bool):
        self.size, arcs = len(rows), []
        for n, (initial, gone, short) in enumerate(rows):
            keeps, more = ({} if gone else KEEPS.get(initial, {})), CUT * short
            for state in STATES:
                node = [("D", DELETE, 4 * (n + 1) + state), ("I", INSERT, 4 * n + NEXT[state])]
                if state in keeps:
                    node.append(("K", more, 4 * (n + 1) + keeps[state]))
                if not gone:
                    node.append(("R", REROLE + more, 4 * (n + 1) + NEXT[state]))
                arcs.append(node)
        for state in STATES:
            arcs.append([("I", INSERT, 4 * self.size + NEXT[state])] if last else [])
        self.arcs, self.end = arcs, 4 * (self.size + 1)
        self.least = [0] * (self.size + 1)  # that the rows from each place on cost
        for n in range(self.size - 1, -1, -1):
            self.least[n] = self.least[n + 1] + (DELETE if rows[n][1] else CUT * rows[n][2])

    def towards(self, ends) -> tuple[list, list[int]]:
        """Arcs with those to the end, and first prices."""
        arcs = [*self.arcs, []]
        for state in STATES:
            node = 4 * self.size + state
            if ends[state] is not None:
                arcs[node] = [("", ends[state], self.end), *arcs[node]]
        leads = self.leading(arcs, lambda node, cost, j: True)
        arcs = [[arc for arc in node if leads[arc[2]]] for node in arcs]  # no price need rise where no way goes
        low = min(e for e in ends if e is not None)
        return arcs, [low + self.least[n // 4] for n in range(4 * (self.size + 1))] + [0]

    def leading(self, arcs: list, passes) -> bytearray:
        """Which nodes lead to the end along arcs that ``passes(node, cost, to)`` lets through."""
        leads = bytearray(self.end + 1)
        leads[self.end] = 1
        for n in range(self.size, -1, -1):
            for _ in STATES:  # inserts stay in their layer
                for node in range(4 * n, 4 * n + 4):
                    if not leads[node] and any(leads[j] and passes(node, cost, j) for _, cost, j in arcs[node]):
                        leads[node] = 1
        return leads

    def auction(self, arcs: list, price: list[int], origin: int) -> int | None:
        """The cheapest cost from ``origin`` to the end; prices rise until they prove it. None: no way."""
        if not arcs[origin]:
            return None
        path = [origin]
        while path[-1] != self.end:
            node = path[-1]
            best, to = None, None
            for _, cost, j in arcs[node]:
                if best is None or cost + price[j] < best:
                    best, to = cost + price[j], j
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def trace(self, arcs: list, price: list[int], origin: int) -> tuple[str, int]:
        """The least audit among the cheapest paths, and the state it ends in."""
        reaches = self.leading(arcs, lambda node, cost, j: price[node] == cost + price[j])
        node, audit = origin, []
        while True:
            letter, to = next((a, j) for a, cost, j in arcs[node] if reaches[j] and price[node] == cost + price[j])
            if to == self.end:
                return "".join(audit), node % 4
            audit.append(letter)
            node = to


def cheapest(rows: list[tuple[str, bool, bool]], ends=FINAL, origin: int = NOTHING, last: bool = True) -> tuple[int, str, int]:
    """Cost, audit and last state of the cheapest edits, the ASCII-least of equals."""
    lattice = Lattice(rows, last)
    arcs, price = lattice.towards(ends)
    cost = lattice.auction(arcs, price, origin)
    return cost, *lattice.trace(arcs, price, origin)


def crossing(rows: list[tuple[str, bool, bool]]) -> list[int | None]:
    """The cost from every state before the rows to every state behind them (row by row); None: no way."""
    lattice, out = Lattice(rows, last=False), [None] * 16
    for goal in STATES:
        arcs, price = lattice.towards([0 if s == goal else None for s in STATES])
        for state in STATES:  # the prices for one goal stay feasible for the next origin
            out[4 * state + goal] = lattice.auction(arcs, price, state)
    return out


def faults(roles, texts, again) -> tuple[list[tuple[str, bool, bool]], list[int]]:
    """Rows as the lattice takes them, and how many are blank, duplicate, truncated."""
    rows, counts = [], [0, 0, 0]
    for role, text, repeated in zip(roles, texts, again):
        seen = text.rstrip(SPACE)
        short = bool(seen) and not repeated and seen[-1] not in ".!?"
        if not seen:
            counts[0] += 1
        elif repeated:
            counts[1] += 1
        counts[2] += short
        rows.append((role[:1], not seen or repeated, short))
    return rows, counts


def edited(roles, texts, audit: str, state: int):
    """The lines that remain."""
    rows = zip(roles, texts)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLE[state] + ":"
            continue
        role, text = next(rows)
        if letter == "K":
            state = KEEPS[role[:1]][state]
            yield f"{role}:{text}"
        elif letter == "R":
            state = NEXT[state]
            yield f"{ROLE[state]}:{text}"


def _illegal(initials) -> int:
    return sum(a + b not in RIGHT for a, b in zip(initials, initials[1:]))


class _Turns:
    """Gaps between turns that come in order, nulls first."""

    def __init__(self) -> None:
        self.first = self.last = None
        self.distinct = 0

    def add(self, turns) -> None:
        for turn in turns:
            if turn is not None and turn != self.last:
                self.first, self.last, self.distinct = (turn if self.first is None else self.first), turn, self.distinct + 1

    def gaps(self) -> int:
        return min(self.last - self.first + 1 - self.distinct, (1 << 63) - 1) if self.distinct else 0


SEGMENTS = "name string, part int, seg int, turns array<string>, roles array<string>, texts array<string>"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
RESULTS = [c.split()[0] for c in RESULT.split(", ")]


def _pack(length: int):
    def run(batches):
        task, out, now, seg, held, size = TaskContext.get().partitionId(), [], None, 0, [], 0

        def close():
            out.append((now, task, seg, *map(list, zip(*held))))

        for batch in batches:
            for name, turn, role, text in zip(batch["name"], batch["digits"], batch["role"], batch["text"]):
                if name != now or len(held) >= length or size >= SEGMENT_BYTES:
                    if held:
                        close()
                    seg, now, held, size = (seg + 1 if name == now else 0), name, [], 0
                held.append((turn, role, text))
                size += len(text)
            if out:
                yield pd.DataFrame(out, columns=["name", "part", "seg", "turns", "roles", "texts"])
                out = []
        if held:
            close()
            yield pd.DataFrame(out, columns=["name", "part", "seg", "turns", "roles", "texts"])
    return run


def _solve(batches):
    """Conversations of one segment."""
    for batch in batches:
        out = []
        for name, turns, roles, texts in zip(batch["name"], batch["turns"], batch["roles"], batch["texts"]):
            seen, again = set(), []
            for x in zip(roles, texts):
                again.append(x in seen)
                seen.add(x)
            rows, counts = faults(roles, texts, again)
            cost, audit, _ = cheapest(rows)
            spans = _Turns()
            spans.add(_numbers(turns))
            text = "\n".join(edited(roles, texts, audit, NOTHING))
            out.append((name, spans.gaps(), *counts, _illegal([r[0] for r in rows]), cost, audit,
                        hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()))
        yield pd.DataFrame(out, columns=["name", *RESULTS])


def _numbers(turns):
    """Turns travel as text: pandas makes doubles of long numbers with nulls."""
    return [None if t is None else int(t) for t in turns]


def _rows_of(batch):
    again = [set() if a is None else set(a) for a in batch["again"]]
    for roles, texts, repeated in zip(batch["roles"], batch["texts"], again):
        yield faults(roles, texts, [n in repeated for n in range(len(roles))])


def _cross(batches):
    for batch in batches:
        yield pd.DataFrame({"name": batch["name"], "part": batch["part"], "seg": batch["seg"],
                            "costs": [[-1 if c is None else c for c in crossing(rows)] for rows, _ in _rows_of(batch)]})


def _prices(batches):
    """From the last segment of a conversation to the first: what the way to the end costs behind each."""
    now, ends = None, None
    for batch in batches:
        out = []
        for name, part, seg, costs in zip(batch["name"], batch["part"], batch["seg"], batch["costs"]):
            if name != now:
                now, ends = name, None
            out.append((name, part, seg, ends))
            behind = _after_inserts(FINAL) if ends is None else ends
            ends = [min((c + e for c, e in zip(costs[4 * s:4 * s + 4], behind) if c >= 0), default=None) for s in STATES]
        yield pd.DataFrame(out, columns=["name", "part", "seg", "ends"])


def _after_inserts(ends) -> list[int]:
    """The price of every state where messages may still be inserted."""
    out = [10 ** 9 if e is None else e for e in ends]
    for _ in STATES:
        out = [min(out[s], INSERT + out[NEXT[s]]) for s in STATES]
    return out


def _traces(batches):
    """Of each segment the edits from every state before it."""
    for batch in batches:
        out = []
        for (rows, counts), ends in zip(_rows_of(batch), batch["ends"]):
            last = ends is None
            found = [cheapest(rows, FINAL if last else [int(e) for e in ends], state, last) for state in STATES]
            initials = [r[0] for r in rows]
            out.append(([f[0] for f in found], [f[1] for f in found], [f[2] for f in found], counts, _illegal(initials), initials[0], initials[-1]))
        yield pd.concat([batch.drop(columns=["again", "ends"]), pd.DataFrame(
            out, columns=["cost", "audits", "states", "counts", "illegal", "opens", "closes"], index=batch.index)], axis=1)


def _follow(batches):
    """Through the segments of a conversation in order, along the states that occur."""
    now, held = None, None

    def close():
        return (now, held["turns"].gaps(), *held["counts"], held["illegal"], held["cost"], "".join(held["audit"]), held["hash"].hexdigest())

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.name != now:
                if held:
                    out.append(close())
                now, held = row.name, {"turns": _Turns(), "counts": [0, 0, 0], "illegal": 0, "cost": int(row.cost[NOTHING]), "audit": [],
                                       "hash": hashlib.sha256(), "state": NOTHING, "closes": None, "lines": False}
            held["turns"].add(_numbers(row.turns))
            held["counts"] = [a + int(b) for a, b in zip(held["counts"], row.counts)]
            held["illegal"] += int(row.illegal) + (held["closes"] is not None and held["closes"] + row.opens not in RIGHT)
            audit = row.audits[held["state"]]
            for line in edited(row.roles, row.texts, audit, held["state"]):
                held["hash"].update((("\n" if held["lines"] else "") + line).encode("utf-8", "replace"))
                held["lines"] = True
            held["audit"].append(audit)
            held["state"], held["closes"] = int(row.states[held["state"]]), row.closes
        if out:
            yield pd.DataFrame(out, columns=["name", *RESULTS])
    if held:
        yield pd.DataFrame([close()], columns=["name", *RESULTS])


def _name(column: str) -> Column:
    return F.when(F.col(column).isNull(), "").otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def repaired(conversations: DataFrame, length: int = SEGMENT, id_column: str = "conv_id") -> DataFrame:
    """A row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = dict(conversations.dtypes)[id_column]
    rows = conversations.select(
        _name(id_column).alias("name"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    segments = written(rows.repartitionByRange("name", "turn", "role", F.substring("text", 1, 64))
                       .sortWithinPartitions("name", "turn", "role", "text")
                       .select("name", F.col("turn").cast("string").alias("digits"), "role", "text").mapInPandas(_pack(length), SEGMENTS), "conversation-segments")
    long = written(segments.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "long-conversations")
    one = segments.join(long, "name", "left_anti").select("name", "turns", "roles", "texts").mapInPandas(_solve, f"name string, {RESULT}")
    several = one.unionByName(_in_parts(segments.join(long, "name", "left_semi")))
    return several.select(F.when(F.col("name") != "", F.substring("name", 2, 1 << 30)).cast(kind).alias(id_column), *RESULTS)


def _in_parts(segments: DataFrame) -> DataFrame:
    key = ["name", "part", "seg"]
    rows = segments.select(*key, F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")).select(
        *key, "at", F.sha2(F.concat_ws(":", F.length("row.roles"), "row.roles", "row.texts"), 256).alias("digest"))
    place = F.struct("part", "seg", "at")
    firsts = rows.groupBy("name", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (rows.join(firsts, ["name", "digest"]).where(place != F.col("first"))
             .groupBy(*key).agg(F.collect_list("at").alias("again")))  # at most a segment's rows
    known = written(segments.join(again, key, "left"), "long-segments")
    costs = known.select(*key, "roles", "texts", "again").mapInPandas(_cross, "name string, part int, seg int, costs array<int>")
    backwards = (costs.repartition("name").sortWithinPartitions("name", F.desc("part"), F.desc("seg"))
                 .mapInPandas(_prices, "name string, part int, seg int, ends array<int>"))
    traced = known.join(backwards, key).mapInPandas(
        _traces, f"{SEGMENTS}, cost array<int>, audits array<string>, states array<int>, counts array<int>, illegal int, opens string, closes string")
    return (traced.repartition("name").sortWithinPartitions(*key)
            .mapInPandas(_follow, f"name string, {RESULT}"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by the checksum of ``conv_id:turn``."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                F.coalesce(F.col("text").cast("string"), space).alias("text"))
    label = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("damage", F.crc32(label) % 20).where("damage != 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("damage") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       copies.alias("copy")).drop("copy")


def repairs_after_damage(conversations: DataFrame, length: int = SEGMENT) -> DataFrame:
    """:func:`repaired` of the damaged rows, with a row for every conversation there was."""
    found = repaired(damaged(conversations), length).withColumn("name", _name("conv_id")).drop("conv_id")
    every = conversations.select("conv_id").distinct().withColumn("name", _name("conv_id"))
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return every.join(found, "name", "left").select(
        "conv_id", *(F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in RESULTS))
