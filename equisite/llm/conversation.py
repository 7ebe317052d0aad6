"""Repair of damaged conversations by the auction algorithm for shortest paths.

Rows of a conversation, in order, span a lattice of (place, what the roles so far ask for next); keeping, giving another
role, deleting and inserting are its arcs, with whole-number costs. The auction grows a path from the origin: the last
node's price rises to the least arc plus price behind it, and the path shrinks by that node or grows along the arc. At
the end prices differ by shortest distances, so every arc of every shortest path is tight; the tight arcs that reach
the end are traced letter by letter, least letter first, over the set of all nodes that share the letters so far.

Equal rows of a turn are one row with a count. Rows are range-partitioned by conversation, turn, role and text and
sorted, so a conversation that holds a third of all rows is spread over partitions; it is cut into blocks of at most
``BLOCK`` rows. A conversation inside one block is solved on the spot. For the others every block gives the least costs
between its first and last states (auctions from each to each); a backward pass over these small rows gives the costs
behind every block, then blocks are traced for every set of states they may be entered by, and a forward pass puts the
pieces together, hashing the text as it streams. Only the strings that are the result, audit and hash, see a
conversation as a whole.

Defined cases: null conv_id, turn, role and text read as one space in the damage key, role and text as one space
everywhere; the null conversation is one conversation. Rows of one turn are ordered by role and text, rows without turn
come first. Repeated rows are rows. An empty role has no initial: it can be given a role or go. Text without a row left:
zeros, an empty audit and the hash of the empty string. Empty table: empty result. Only conv_id, turn, role and text
are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equisite.llm.base import arrow_schema
from equisite.llm.vectors import by_key, content_key
from equisite.plans.session import materialise

BLANKS = " \t\n\u000b\f\r"
PREFIX = 64
"""Characters of a text that range bounds are made of; the sort inside a partition takes all."""

BLOCK = 64
BLOCK_BYTES = 1 << 20
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

START, SYSTEM, USER, ASSISTANT = range(4)
"""What was put out last; the language is (s?(ua)+)?."""

NEXT = (USER, USER, ASSISTANT, USER)
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
BEHIND = (0, 2 * INSERT, INSERT, 0)
"""Cost of what the last row leaves to insert, and its letters."""

TAIL = ("", "II", "I", "")
NAMES = {USER: "user", ASSISTANT: "assistant"}


# --- lattice of one block: steps are (initial, truncated, count); count 0 is a row that may stay, else a run to delete ---

class Lattice:
    """Steps of a block and the costs behind its last states; node 4 * place + state, the end is the last node."""

    def __init__(self, steps: list[tuple[str, bool, int]], behind):
        self.steps, self.behind, self.end = steps, behind, 4 * len(steps) + 4
        self.price = [0] * (self.end + 1)
        self.open = None if None not in behind else self.leading(lambda node, cost, to: True)

    def leading(self, good) -> list[bool]:
        """Nodes from which arcs that are ``good`` lead to the end."""
        live = [False] * self.end + [True]
        for place in range(len(self.steps), -1, -1):
            for _ in range(3):  # inserts stay at a place, at most two in a row
                for node in range(4 * place, 4 * place + 4):
                    live[node] = live[node] or any(live[to] and good(node, cost, to) for _, cost, to in self.arcs(node))
        return live

    def alive(self) -> list[bool]:
        """Nodes from which tight arcs lead to the end."""
        return self.leading(lambda node, cost, to: self.price[node] == cost + self.price[to])

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, cost, node) in the order of the letters."""
        place, state = divmod(node, 4)
        if place == len(self.steps):
            return [("", self.behind[state], self.end)] if self.behind[state] is not None else []
        initial, truncated, count = self.steps[place]
        after = node - state + 4
        out = [("D", DELETE * max(1, count), after + state), ("I", INSERT, node - state + NEXT[state])]
        if not count:
            extra = TRUNCATED if truncated else 0
            kept = KEEP[state].get(initial)
            if kept is not None:
                out.append(("K", extra, after + kept))
            out.append(("R", REROLE + extra, after + NEXT[state]))
        return out

    def auction(self, source: int) -> int:
        """Shortest distance to the end; prices stay a lower bound of every node's and serve the next source."""
        price, path, known = self.price, [source], {}
        if self.open and not self.open[source]:
            return 1 << 60
        while True:
            node = path[-1]
            if node == self.end:
                return price[source] - price[self.end]
            arcs = known.get(node)
            if arcs is None:
                arcs = known[node] = [(cost, to) for _, cost, to in self.arcs(node) if not self.open or self.open[to]]
            least, to = min([(cost + price[other], other) for cost, other in arcs])
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def traced(self, states: list[int], live: list[bool]) -> tuple[str, list[int]]:
        """Least letters from the states at the first place to the last, and the states they end in."""
        front, letters = [s for s in states if live[s]], []
        last = 4 * len(self.steps)
        while front and front[0] < last:
            best, reached = "Z", []
            for node in front:
                for letter, cost, to in self.arcs(node):
                    if letter <= best and live[to] and self.price[node] == cost + self.price[to]:
                        reached = reached + [to] if letter == best else [to]
                        best = letter
            letters.append(best * max(1, self.steps[front[0] // 4][2]) if best == "D" else best)
            front = sorted(set(reached))
        return "".join(letters), [n - last for n in front]


def between(steps) -> list[int]:
    """Least costs from every first to every last state of a block, row by row; 2^60 where there is no way."""
    out = [[0] * 4 for _ in range(4)]
    for last in range(4):
        lattice = Lattice(steps, [0 if s == last else None for s in range(4)])
        for first in range(4):
            out[first][last] = lattice.auction(first)
    return [x for row in out for x in row]


def tail_of(states: list[int]) -> str:
    return min(TAIL[s] for s in states)


class Replay:
    """Puts pieces of the audit to the rows they speak of."""

    def __init__(self):
        self.state, self.cost, self.hash, self.pieces, self.first = START, 0, hashlib.sha256(), [], True

    def put(self, role: str, text: str) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def block(self, audit: str, steps, roles: list[str], texts: list[str]) -> None:
        at = place = 0
        while at < len(audit):
            letter = audit[at]
            initial, truncated, count = steps[place] if place < len(steps) else ("", False, 0)
            if letter == "D":
                self.cost += DELETE * max(1, count)
                at += max(1, count) - 1
            elif letter == "I":
                self.state = NEXT[self.state]
                self.cost += INSERT
                self.put(NAMES[self.state], "")
                place -= 1
            else:
                self.cost += (TRUNCATED if truncated else 0) + (REROLE if letter == "R" else 0)
                self.state = NEXT[self.state] if letter == "R" else KEEP[self.state][initial]
                self.put(NAMES[self.state] if letter == "R" else roles[place], texts[place])
            place += 1
            at += 1
        self.pieces.append(audit)

    def result(self) -> dict:
        return {"cost": self.cost, "audit": "".join(self.pieces), "repaired_sha256": self.hash.hexdigest()}


class Counts:
    """Gaps, faults and adjacent roles over consecutive collapsed rows or blocks of them."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first_role", "last_role")

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def row(self, r: dict) -> None:
        n, extra = r["n"], r["n"] - (0 if r["again"] else 1)
        self.add({"blank": n if r["blank"] else 0, "duplicate": 0 if r["blank"] else extra,
                  "truncated": 1 if r["cut"] and not r["blank"] and not r["again"] else 0, "illegal": n - 1,
                  "turns": 0 if r["turn"] is None else 1, "first_turn": r["turn"], "last_turn": r["turn"],
                  "first_role": r["initial"], "last_role": r["initial"]})

    def add(self, x: dict) -> None:
        """``x`` follows what there is."""
        for k in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + x[k])
        if self.last_role is not None and self.last_role + x["first_role"] not in ("su", "ua", "au"):
            self.illegal += 1
        self.turns += x["turns"] - (1 if x["turns"] and x["first_turn"] == self.last_turn else 0)
        self.last_turn = x["last_turn"] if x["last_turn"] is not None else self.last_turn
        self.first_turn = self.first_turn if self.first_turn is not None else x["first_turn"]
        self.first_role = self.first_role if self.first_role is not None else x["first_role"]
        self.last_role = x["last_role"]

    def values(self) -> dict:
        return {k: getattr(self, k) for k in self.FIELDS}

    def result(self) -> dict:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


# --- rows ---

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage, equal ones of a turn as one with their number."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), code.alias("_c")).filter("_c <> 0")
    text = F.when(F.col("_c") == 1, "").when(F.col("_c") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    changed = hit.select("conv_id", "turn", F.when(F.col("_c") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                         F.when(F.col("_c") == 3, 2).otherwise(1).alias("_n"))
    return changed.groupBy("conv_id", "turn", "role", "text").agg(F.sum("_n").alias("n"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds initial, blank, cut (truncated) and again (all copies were seen in an earlier turn)."""
    keyed = rows.withColumn("_k", content_key("conv_id", "role", "text")).withColumn("_o", F.struct(F.col("turn").isNotNull().alias("t"), "turn"))
    seen = (keyed.groupBy("_k").agg(F.min("_o").alias("_first"), F.count(F.lit(1)).alias("_times")).filter("_times > 1")
            .select("_k", "_first"))
    bare = F.rtrim("text", F.lit(BLANKS))
    return keyed.join(seen, "_k", "left").select(
        "conv_id", "turn", "role", "text", "n", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.coalesce(F.col("_o") > F.col("_first"), F.lit(False)).alias("again"))


STEPS = "initials array<string>, cuts array<boolean>, runs array<bigint>, roles array<string>, texts array<string>"
STATS = ("blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, "
         "first_role string, last_role string")


def steps_of(row: dict) -> list[tuple[str, bool, int]]:
    return list(zip(row["initials"], row["cuts"], row["runs"]))


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks in order: conv_id, part, seq, whole (nothing of the conversation is elsewhere), steps and counts."""
    schema = f"conv_id bigint, part int, seq bigint, whole boolean, {STEPS}, {STATS}"
    arrow = arrow_schema(schema)

    def cut(batches):
        from pyspark import TaskContext
        part, seq, ready, size = TaskContext.get().partitionId(), 0, [], 0
        held, counts, begun, opened, space = None, None, None, True, 0

        def closed(whole):
            nonlocal held, counts, seq, size, space
            if held is None:
                return
            ready.append({"conv_id": begun[0], "part": part, "seq": seq, "whole": whole} | held | counts.values())
            size += 200 + space
            held, counts, seq, space = None, None, seq + 1, 0

        def many():
            nonlocal ready, size
            out, ready, size = pa.RecordBatch.from_pylist(ready, schema=arrow), [], 0
            return out

        for batch in batches:
            for r in batch.to_pylist():
                if begun is None or (r["conv_id"],) != begun:
                    if begun is not None:
                        closed(opened and not first)
                        first = False
                    else:
                        first = True
                    begun, opened = (r["conv_id"],), True
                if held is not None and (len(held["runs"]) >= block or space >= BLOCK_BYTES):
                    opened = False
                    closed(False)
                if held is None:
                    held, counts = {k: [] for k in ("initials", "cuts", "runs", "roles", "texts")}, Counts()
                counts.row(r)
                gone = r["blank"] or r["again"]
                for run, role, text in ([] if gone else [(0, r["role"], r["text"])]) + ([(r["n"] - (not gone), "", "")] if gone or r["n"] > 1 else []):
                    for k, v in zip(held, (r["initial"], bool(r["cut"]), run, role, text)):
                        held[k].append(v)
                space += 0 if gone else len(r["text"])
            if size >= 4 << 20 or len(ready) >= 5000:
                yield many()
        closed(False)
        yield many()

    order = ["conv_id", "turn", "role"]
    return (rows.repartitionByRange(*order, F.substring("text", 1, PREFIX)).sortWithinPartitions(*order, "text")
            .mapInArrow(cut, schema))


RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


def solved(whole: DataFrame) -> DataFrame:
    """Results of the conversations that are one block."""
    arrow = arrow_schema(RESULT)

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                steps = steps_of(row)
                lattice = Lattice(steps, BEHIND)
                lattice.auction(START)
                audit, ends = lattice.traced([START], lattice.alive())
                counts, replay = Counts(), Replay()
                counts.add(row)
                replay.block(audit + tail_of(ends), steps, row["roles"], row["texts"])
                out.append({"conv_id": row["conv_id"]} | counts.result() | replay.result())
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return whole.mapInArrow(run, RESULT)


def costs_behind(parts: DataFrame) -> DataFrame:
    """(part, seq, behind): least costs from the last states of every block to the end of its conversation."""
    middle, schema = "conv_id bigint, part int, seq bigint, between array<bigint>", "part int, seq bigint, behind array<bigint>"
    first, second = arrow_schema(middle), arrow_schema(schema)

    def inside(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("conv_id", "part", "seq")} | {"between": between(steps_of(row))}
                                              for row in batch.to_pylist()], schema=first)

    def backward(batches):
        current, behind = None, None
        for key, some in by_key(batches, ["conv_id"]):
            if key != current:
                current, behind = key, list(BEHIND)
            out = []
            for row in some.to_pylist():
                out.append({"part": row["part"], "seq": row["seq"], "behind": behind})
                ways = row["between"]
                behind = [min(ways[4 * a + b] + behind[b] for b in range(4)) for a in range(4)]
            yield pa.RecordBatch.from_pylist(out, schema=second)

    costs = parts.select("conv_id", "part", "seq", "initials", "cuts", "runs").mapInArrow(inside, middle)
    return (costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq")).mapInArrow(backward, schema))


def joined(parts: DataFrame) -> DataFrame:
    """Results of conversations of several blocks (or at the edge of a partition)."""
    traces = "pieces array<string>, exits array<array<int>>"
    columns = [c for c in parts.columns if c != "whole"]
    schema = ", ".join(f"{n} {t}" for n, t in parts.select(*columns).dtypes) + ", " + traces
    first, second = arrow_schema(schema), arrow_schema(RESULT)

    def trace(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lattice = Lattice(steps_of(row), row.pop("behind"))
                for state in range(4):
                    lattice.auction(state)
                live = lattice.alive()
                # number 1 to 15: the set of states that the block is entered by
                found = [lattice.traced([s for s in range(4) if n >> s & 1], live) for n in range(1, 16)]
                out.append(row | {"pieces": [p for p, _ in found], "exits": [x for _, x in found]})
            yield pa.RecordBatch.from_pylist(out, schema=first)

    def forward(batches):
        current, counts, replay, states = None, None, None, [START]

        def ended():
            replay.block(tail_of(states), [], [], [])
            return pa.RecordBatch.from_pylist([{"conv_id": current[0]} | counts.result() | replay.result()], schema=second)

        for key, some in by_key(batches, ["conv_id"]):
            if key != current:
                if current is not None:
                    yield ended()
                current, counts, replay, states = key, Counts(), Replay(), [START]
            for row in some.to_pylist():
                number = sum(1 << s for s in states) - 1
                counts.add(row)
                replay.block(row["pieces"][number], steps_of(row), row["roles"], row["texts"])
                states = row["exits"][number]
        if current is not None:
            yield ended()

    traced = parts.select(*columns).join(materialise(costs_behind(parts), "costs"), ["part", "seq"]).select(*columns, "behind").mapInArrow(trace, schema)
    return traced.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(forward, RESULT)


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: counts after damage, cost, audit and the hash of the repaired text."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    cut = materialise(blocks(with_faults(materialise(damaged(rows), "damaged")), block), "blocks")
    found = solved(cut.filter("whole")).unionByName(joined(cut.filter("NOT whole"))).withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct()
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(found, every["conv_id"].eqNullSafe(found["_id"]), "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256"))


def oracle_sql() -> str:
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def more(v: str, cost: str, letter: str) -> str:
        return f"printf('%012d', substr({v}, 1, 12)::BIGINT + {cost}) || '{letter}' || substr({v}, 13)"

    def step(state: int) -> str:
        kept = " ".join(f"WHEN x.initial = '{i}' THEN {more(f'dp.v{s}', 'x.extra', 'K')}" for i, s in KEEP[state].items())
        return (f"least({more(f'dp.v{state}', str(DELETE), 'D')}, CASE WHEN x.stays THEN {more(f'dp.v{NEXT[state]}', f'{REROLE} + x.extra', 'R')} END, "
                f"CASE WHEN NOT x.stays THEN NULL {kept} END) AS w{state}")

    return f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, t,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations, tab),
h AS (SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS code FROM c),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (SELECT *, left(role, 1) AS initial, rtrim(text, {blanks}) AS bare,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
g AS MATERIALIZED (SELECT *, bare = '' AS blank, bare <> '' AND again AS dup, bare <> '' AND NOT again AS stays,
  CASE WHEN bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS extra,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM f),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
  count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE extra > 0) AS truncated,
  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows FROM g GROUP BY conv_id),
dp AS (SELECT conv_id, rows + 1 AS i, {', '.join(f"printf('%012d', {c}) || '{t}' AS v{q}" for q, (c, t) in enumerate(zip(BEHIND, TAIL)))} FROM s
  UNION ALL
  SELECT conv_id, i, least(w0, {more('u2', str(INSERT), 'I')}), least(w1, {more('u2', str(INSERT), 'I')}), u2, least(w3, {more('u2', str(INSERT), 'I')})
  FROM (SELECT *, least(w2, {more('w3', str(INSERT), 'I')}) AS u2 FROM (
    SELECT dp.conv_id, x.i, {', '.join(map(step, range(4)))} FROM dp JOIN g x ON x.conv_id IS NOT DISTINCT FROM dp.conv_id AND x.i = dp.i - 1))),
best AS MATERIALIZED (SELECT conv_id, substr(v0, 1, 12)::BIGINT AS cost, substr(v0, 13) AS audit FROM dp WHERE i = 1),
l AS (SELECT conv_id, unnest(string_split(audit, '')) AS op, unnest(range(1, length(audit) + 1)) AS k FROM best WHERE audit <> ''),
m AS (SELECT *, count(*) FILTER (WHERE op <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i FROM l),
y AS (SELECT m.conv_id, m.op, m.k, g.role, g.text, row_number() OVER (PARTITION BY m.conv_id ORDER BY m.k) AS place,
  first_value(m.op = 'K' AND g.initial = 's') OVER (PARTITION BY m.conv_id ORDER BY m.k) AS system
  FROM m LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND g.i = m.i AND m.op <> 'I' WHERE m.op <> 'D'),
z AS (SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (place - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
  || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM y GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM e.conv_id"""
