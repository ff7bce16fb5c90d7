"""Conversation structure repair by bidirectional Dijkstra over an edit lattice.

A conversation's rows are kept (K), given the role that must come next (R),
deleted (D) or preceded by an inserted empty turn (I), so that the roles read
``(s?(ua)+)?``. Nodes of the lattice are (rows consumed, role of the last turn
that stands); edges are edits. A forward heap starts at the first row and a
reverse heap behind the last; once their least costs together exceed the best
crossing, all crossings of equal cost are known, and the least concatenated
audit of them is the repair.

A conversation may hold any share of all rows. So rows are ranked in ranges,
and the search runs in blocks of ``BLOCK`` neighbours. A block alone gives, for each
role that may stand before it and each that may stand behind it, the cheapest
audit. Inserted turns belong to the row they precede, so audits of one block
with the same role before it differ inside the block or not at all: costs and
the order of these audits are all that joins blocks. ``FAN`` of such summaries
are combined into one, level by level, until a conversation has one; on the
way back each block learns which roles its neighbours chose, and its audit and
repaired turns follow. Conversations of up to a block take one search.
Only the repaired text itself is hashed one block after another, since SHA-256
has no other way; it is streamed.

Contract, also for other tables: ``conv_id``, ``turn``, ``role`` and ``text``,
any of them null. A null conv_id is a conversation of its own. Null roles and
texts count as one blank. Rows stand by turn (null first), then by role, text
and copy. A role's initial is its first character; an empty role has none and
cannot be kept. Repeated rows are rows. An empty table returns no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import BLANKS, Table, id_key, ranked, same, stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
BLOCK, FAN = 256, 512
#: What stands last: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert behind the last row.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
NONE = 1 << 60

#: A row for the search: role's initial, must go, truncated.
Row = tuple[str, bool, bool]


def _kept(state: int, initial: str) -> int | None:
    if state == START and initial == "s":
        return SYSTEM
    if initial == ROLES[NEXT[state]][0]:
        return NEXT[state]
    return None


def _edges(row: Row) -> list[tuple[int, str, int, int]]:
    """(state before, edit, cost, state behind) of every edit of one row."""
    initial, gone, truncated = row
    out = [(s, DELETE, DELETE_COST, s) for s in STATES]
    if not gone:
        extra = TRUNCATED_COST if truncated else 0
        for s in STATES:
            if (to := _kept(s, initial)) is not None:
                out.append((s, KEEP, extra, to))
            out.append((s, REROLE, REROLE_COST + extra, NEXT[s]))
    return out


def cheapest(rows: list[Row], first: int, last: int) -> tuple[int, str] | None:
    """Least cost, and the ASCII-least audit of that cost, from state
    ``first`` before the rows to ``last`` behind them; None if there is none.
    No turn is inserted behind the last row."""
    n, edges = len(rows), [_edges(r) for r in rows]
    onward = [[[e for e in at if e[0] == s] for s in STATES] for at in edges]
    backward = [[[e for e in at if e[3] == s] for s in STATES] for at in edges]
    ahead: dict[tuple[int, int], tuple[int, str]] = {(0, first): (0, "")}
    behind: dict[tuple[int, int], tuple[int, str]] = {(n, last): (0, "")}
    # equal costs by rows consumed: a kept row costs nothing
    heap, reverse = [(0, 0, first)], [(0, 0, last)]
    done, rdone = set(), set()
    best = NONE
    if first == last and n == 0:
        return 0, ""

    def relax(labels, queue, node, label, steps, other):
        nonlocal best
        if node not in labels or label < labels[node]:
            labels[node] = label
            heapq.heappush(queue, (label[0], steps, node[1]))
            if node in other:
                best = min(best, label[0] + other[node][0])

    while heap and reverse and heap[0][0] + reverse[0][0] <= best:
        if heap[0][0] <= reverse[0][0]:
            cost, i, state = heapq.heappop(heap)
            if (i, state) in done or i == n:
                continue
            done.add((i, state))
            cost, audit = ahead[i, state]
            for _, edit, price, to in onward[i][state]:
                relax(ahead, heap, (i + 1, to), (cost + price, audit + edit), i + 1, behind)
            relax(ahead, heap, (i, NEXT[state]), (cost + INSERT_COST, audit + INSERT), i, behind)
        else:
            cost, steps, state = heapq.heappop(reverse)
            i = n - steps
            if (i, state) in rdone:
                continue
            rdone.add((i, state))
            cost, audit = behind[i, state]
            if i:
                for before, edit, price, _ in backward[i - 1][state]:
                    relax(behind, reverse, (i - 1, before), (cost + price, edit + audit),
                          steps + 1, ahead)
            if i < n:
                for before in STATES:
                    if NEXT[before] == state:
                        relax(behind, reverse, (i, before), (cost + INSERT_COST, INSERT + audit),
                              steps, ahead)
    if best == NONE:
        return None
    return min((ahead[v][0] + behind[v][0], ahead[v][1] + behind[v][1])
               for v in ahead.keys() & behind.keys())


def closed(options: dict[int, tuple[int, str]]) -> tuple[int, int]:
    """Cost and state behind the last row of the best way to end there."""
    cost, _, state = min((c + INSERT_COST * CLOSING[s], order, s)
                         for s, (c, order) in options.items())
    return cost, state


def _summary(rows: list[Row], firsts) -> tuple[list[int], list[int], list[str]]:
    """Costs, orders and audits by 4 * state before + state behind."""
    cost, order, audits = [NONE] * 16, [0] * 16, [""] * 16
    for s in firsts:
        found = {t: x for t in STATES if (x := cheapest(rows, s, t)) is not None}
        ranks = sorted({audit for _, audit in found.values()})
        for t, (c, audit) in found.items():
            cost[4 * s + t], order[4 * s + t] = c, ranks.index(audit)
            audits[4 * s + t] = audit
    return cost, order, audits


def _through(children: list[tuple[list[int], list[int]]], first: int) -> list[dict]:
    """Per child the states behind it: state -> (cost, order, state before)."""
    now, out = {first: (0, 0, None)}, []
    for cost, order in children:
        reached: dict[int, tuple] = {}
        for s, (c, o, _) in now.items():
            for t in STATES:
                if cost[4 * s + t] < NONE:
                    label = (c + cost[4 * s + t], o, order[4 * s + t], s)
                    if t not in reached or label < reached[t]:
                        reached[t] = label
        ranks = sorted({label[1:3] for label in reached.values()})
        now = {t: (c, ranks.index((o, r)), s) for t, (c, o, r, s) in reached.items()}
        out.append(now)
    return out


def combine(children: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """Costs and orders of neighbouring blocks as one."""
    cost, order = [NONE] * 16, [0] * 16
    for s in STATES:
        for t, (c, o, _) in _through(children, s)[-1].items():
            cost[4 * s + t], order[4 * s + t] = c, o
    return cost, order


def path(children: list[tuple[list[int], list[int]]], first: int, last: int) -> list[int]:
    """States before each child and behind the last one, on the best way."""
    out = [last]
    for reached in reversed(_through(children, first)):
        out.append(reached[out[-1]][2])
    return out[::-1]


def _groups(batches, keys: list[str]):
    """Rows (as dicts) of equal ``keys`` from sorted Arrow batches."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and key != at:
                yield held
                held = []
            at = key
            held.append(row)
    if held:
        yield held


def _batches(rows, schema: pa.Schema, size: int = 256):
    """Arrow batches of tuples."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types,
                                                strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)],
            schema=schema)


def _per_group(df: DataFrame, keys: list[str], order: list[str], run, kinds: dict) -> DataFrame:
    """``run`` (rows -> tuples) on each group, streamed through sorted
    partitions: a task holds one group at a time."""
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(k, arrow[t]) for k, t in kinds.items()])
    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return sorted_rows.mapInArrow(
        lambda batches: _batches((x for g in _groups(batches, keys) for x in run(g)), schema),
        ", ".join(f"{k} {t}" for k, t in kinds.items()))


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per block: summary, audits, counts and outer initials."""

    def run(group):
        conv, block = group[0]["conv"], group[0]["block"]
        initials = [r["role"][:1] for r in group]
        faults = [r["fault"] for r in group]
        search = [(i, f in ("blank", "duplicate"), f == "truncated")
                  for i, f in zip(initials, faults, strict=True)]
        cost, order, audits = _summary(search, STATES if block else [START])
        illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:], strict=False))
        yield (conv, block, cost, order, audits, *[faults.count(f) for f in FAULTS], illegal,
               initials[0], initials[-1])

    return _per_group(rows.select("conv", "block", "pos", "role", "fault"), ["conv", "block"],
                      ["pos"], run, {
        "conv": "string", "block": "long", "cost": "array<long>", "order": "array<long>",
        "audits": "array<string>", **dict.fromkeys(FAULTS, "long"), "illegal": "long",
        "head": "string", "tail": "string"})


FAULTS = ("blank", "duplicate", "truncated")


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _level_up(level: DataFrame) -> DataFrame:
    """FAN neighbouring summaries as one."""

    def run(group):
        yield (group[0]["conv"], group[0]["up"],
               *combine([(r["cost"], r["order"]) for r in group]))

    up = level.select("conv", F.expr(f"block div {FAN}").alias("up"), "block", "cost", "order")
    return _per_group(up, ["conv", "up"], ["block"], run, {
        "conv": "string", "block": "long", "cost": "array<long>", "order": "array<long>"})


def _level_down(level: DataFrame, above: DataFrame) -> DataFrame:
    """conv, block and the states before and behind each block (first, last),
    from those of the level above."""

    def run(group):
        states = path([(r["cost"], r["order"]) for r in group], group[0]["first"],
                      group[0]["last"])
        for r, a, b in zip(group, states, states[1:], strict=False):
            yield r["conv"], r["block"], a, b

    up = level.select("conv", F.expr(f"block div {FAN}").alias("up"), "block", "cost", "order")
    joined = up.join(above.select("conv", F.col("block").alias("up"), "first", "last"),
                     ["conv", "up"])
    return _per_group(joined, ["conv", "up"], ["block"], run, dict(
        zip(("conv", "block", "first", "last"), ("string", "long", "long", "long"),
            strict=True)))


def _ends(top: DataFrame) -> DataFrame:
    """conv, block 0, first, last and cost of the one summary a conversation has."""

    def run(group):
        for r in group:
            cost, state = closed({t: (r["cost"][t], r["order"][t]) for t in STATES
                                  if r["cost"][t] < NONE})
            yield r["conv"], 0, START, state, cost

    return _per_group(top, ["conv"], ["block"], run, dict(
        zip(("conv", "block", "first", "last", "total"),
            ("string", "long", "long", "long", "long"), strict=True)))


def _repaired(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """conv, block and its repaired turns as ``role:text`` lines."""

    def run(group):
        state, turns, lines = group[0]["first"], iter(group), []
        for edit in group[0]["audit"]:
            if edit == INSERT:
                state = NEXT[state]
                lines.append(f"{ROLES[state]}:")
                continue
            row = next(turns)
            if edit == KEEP:
                state = _kept(state, row["role"][:1])
                lines.append(f"{row['role']}:{row['text']}")
            elif edit == REROLE:
                state = NEXT[state]
                lines.append(f"{ROLES[state]}:{row['text']}")
        yield group[0]["conv"], group[0]["block"], "\n".join(lines) if lines else None

    joined = rows.select("conv", "block", "pos", "role", "text").join(
        blocks.select("conv", "block", "first", "audit"), ["conv", "block"])
    return _per_group(joined, ["conv", "block"], ["pos"], run,
                      {"conv": "string", "block": "long", "lines": "string"})


def _assembled(blocks: DataFrame) -> DataFrame:
    """One row per conversation from its blocks in order."""

    def run(batches):
        held = None

        def finished(h):
            for state in [USER, ASSISTANT][-CLOSING[h["state"]]:] if CLOSING[h["state"]] else []:
                h["audit"].append(INSERT)
                write(h, f"{ROLES[state]}:")
            return (h["conv"], *[h[f] for f in FAULTS], h["illegal"], "".join(h["audit"]),
                    h["sha"].hexdigest())

        def write(h, lines):
            h["sha"].update((("\n" if h["some"] else "") + lines).encode())
            h["some"] = True

        for batch in batches:
            for r in batch.to_pylist():
                if held is None or held["conv"] != r["conv"]:
                    if held is not None:
                        yield finished(held)
                    held = {"conv": r["conv"], **dict.fromkeys(FAULTS, 0), "illegal": 0,
                            "audit": [], "sha": hashlib.sha256(), "some": False}
                else:
                    held["illegal"] += not legal(held["tail"], r["head"])
                for f in (*FAULTS, "illegal"):
                    held[f] += r[f]
                held["tail"], held["state"] = r["tail"], r["last"]
                held["audit"].append(r["audit"])
                if r["lines"] is not None:
                    write(held, r["lines"])
        if held is not None:
            yield finished(held)

    kinds = {"conv": pa.string(), **dict.fromkeys(FAULTS, pa.int64()), "illegal": pa.int64(),
             "audit": pa.string(), "repaired_sha256": pa.string()}
    schema = pa.schema(list(kinds.items()))
    ordered = blocks.repartition("conv").sortWithinPartitions("conv", "block")
    return ordered.mapInArrow(
        lambda batches: _batches(run(batches), schema, 16),
        "conv string, blank long, duplicate long, truncated long, illegal long, audit string, "
        "repaired_sha256 string")


def _faulty(rows: Table) -> DataFrame:
    """Ranked rows with their block and first fault. A first occurrence is a
    minimum by role and text, map-side combined and written before it is
    joined, so a turn that fills a conversation is no single task."""
    named = rows.df.withColumn("sha", F.sha2("text", 256))
    firsts = stage(named.groupBy("conv", "role", "sha").agg(F.min("pos").alias("seen")),
                   "first-turns").df
    word = f"[^{BLANKS}]"
    joined = named.join(firsts, ["conv", "role", "sha"])
    last = F.regexp_extract("text", f"({word})[{BLANKS}]*\\z", 1)
    fault = (F.when(~F.col("text").rlike(word), "blank")
             .when(F.col("pos") > F.col("seen"), "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    return joined.select("conv", "pos", F.expr(f"pos div {BLOCK}").alias("block"), "role", "text",
                         fault.alias("fault"))


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it a user's; nulls are one blank."""
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank)
                             for c in ("conv_id", "turn")])
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20).where("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2,
                                                 F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.sequence(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation in ``turns``, whose column ``copy``
    numbers rows that repeat one another."""
    written = stage(turns.select(
        "conv_id", id_key(F.col("conv_id")).alias("conv"), "turn",
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], "copy",
        F.monotonically_increasing_id().alias("row")), "turns")
    gaps = written.df.groupBy("conv_id", "conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    placed = ranked(written.df, ["conv"], ["turn", "role", "text", "copy", "row"], "pos")
    rows = stage(_faulty(placed), "faulty-turns").df
    blocks = stage(_blocks(rows), "turn-blocks").df
    levels, most = [blocks], blocks.agg(F.max("block")).first()[0] or 0
    while most:
        levels.append(stage(_level_up(levels[-1]), "turn-blocks-up").df)
        most //= FAN
    ends = stage(_ends(levels[-1].select("conv", "block", "cost", "order")), "turn-ends").df
    states = ends.select("conv", "block", "first", "last")
    for level in levels[-2::-1]:
        states = stage(_level_down(level, states), "turn-states").df
    audit = F.element_at("audits", (4 * F.col("first") + F.col("last") + 1).cast("int"))
    chosen = stage(blocks.join(states, ["conv", "block"]).select(
        "conv", "block", *FAULTS, "illegal", "head", "tail", "first", "last",
        audit.alias("audit")), "turn-audits").df
    lines = stage(_repaired(rows, chosen), "turn-lines").df
    whole = _assembled(chosen.join(lines, ["conv", "block"]))
    return (gaps.join(whole, "conv").join(ends.select("conv", F.col("total").alias("cost")), "conv")
            .select("conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"))


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """``repair`` after ``damage``, one row for every conv_id of ``turns``; one
    of which no row is left has zeros, no audit and the digest of no text."""
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = repair(damage(turns))
    joined = ids.alias("l").join(found.alias("r"), same(ids, found, ["conv_id"]), "left")
    counts = ("gaps", *FAULTS, "illegal", "cost")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return joined.select("l.conv_id", *[F.coalesce(f"r.{c}", F.lit(0)).cast("long").alias(c)
                                        for c in counts],
                         *[F.coalesce(f"r.{c}", F.lit(v)).alias(c) for c, v in nothing.items()])
