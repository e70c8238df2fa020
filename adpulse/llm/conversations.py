"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows consumed, state); the state says what the repaired
roles so far end with: nothing, the system row, a user row, an assistant row.
Keeping, re-roling and deleting a row lead to the next column, inserting a
message stays in its column. Two heaps grow from both ends until no cheaper
meeting is left; every node that lies on a meeting of equal cost is a crossing,
and the least concatenation of the audits before and behind one is the answer.
Equal-cost audits at one node are never one the beginning of the other (both
consume the same rows, and further inserts cost), so the least half is always
part of the least whole.

Spark orders and marks the rows, deals conversations out as strings of one
symbol a row in blocks of at most BLOCK rows, searches each block between every
state it may be entered and left in, chooses the chain of blocks per
conversation, and sends the edits back to the rows. So a conversation of any
length is searched in many tasks; what meets in one is a few numbers per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import ship, stored

BLOCK = 1024
WHITE = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (NONE, ASSISTANT)
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5  # costs; keeping is free
AFTER = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
EXPECTED = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # what an insertion or a new role gives


# -- the lattice of one block -----------------------------------------------------------

def _steps(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, state, cost) of the edits that consume a row. The symbol is x
    for a row that has to go, else the initial of its role, as a capital if
    the text is truncated."""
    found = [("D", state, DELETE)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        found.append(("R", EXPECTED[state], REROLE + extra))
        if (kept := AFTER.get((state, symbol.lower()))) is not None:
            found.append(("K", kept, extra))
    return found


_FORWARD = {(c, q): _steps(c, q) for c in "xsuaoSUAO" for q in range(4)}
_BACKWARD = {(c, q): [(letter, p, cost) for p in range(4) for letter, to, cost in _FORWARD[c, p] if to == q] for c in "xsuaoSUAO" for q in range(4)}
_INSERTED_FROM = {q: [p for p in range(4) if EXPECTED[p] == q] for q in range(4)}


def cheapest(symbols: str, entry: int, exits: tuple[int, ...], closed: bool) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from the entry to one of the exits,
    of equals the least audit; a closed block leaves insertions behind its last
    row to the next one."""
    n = len(symbols)
    labels: tuple[dict, dict] = ({(0, entry): (0, "")}, {(n, q): (0, "") for q in exits})
    heaps: tuple[list, list] = ([(0, 0, entry)], [(0, 0, q) for q in exits])  # cost, columns walked, state
    settled: tuple[set, set] = (set(), set())
    least = min((0 for q in exits if (n, q) == (0, entry)), default=None)
    while heaps[0] and heaps[1]:
        if least is not None and heaps[0][0][0] + heaps[1][0][0] > least:
            break
        side = int(heaps[1][0][0] < heaps[0][0][0])
        cost, walked, q = heappop(heaps[side])
        i = n - walked if side else walked
        if (i, q) in settled[side]:
            continue
        settled[side].add((i, q))
        audit = labels[side][i, q][1]
        if side:
            edges = [(letter, i - 1, p, c) for letter, p, c in _BACKWARD[symbols[i - 1], q]] if i else []
            if not (closed and i == n):
                edges += [("I", i, p, INSERT) for p in _INSERTED_FROM[q]]
        else:
            edges = [(letter, i + 1, p, c) for letter, p, c in _FORWARD[symbols[i], q]] if i < n else []
            if not (closed and i == n):
                edges.append(("I", i, EXPECTED[q], INSERT))
        # edges without cost lead one column on, so a label is final when it is settled
        for letter, j, p, c in edges:
            label = (cost + c, letter + audit if side else audit + letter)
            before = labels[side].get((j, p))
            if before is None or label < before:
                labels[side][j, p] = label
                if before is None or label[0] < before[0]:
                    heappush(heaps[side], (label[0], n - j if side else j, p))
                if (other := labels[1 - side].get((j, p))) is not None and (least is None or label[0] + other[0] < least):
                    least = label[0] + other[0]
    if least is None:
        return None
    return least, min(there[1] + labels[1][node][1] for node, there in labels[0].items()
                      if node in labels[1] and there[0] + labels[1][node][0] == least)


def written_out(symbols: str, entry: int, audit: str) -> str:
    """The audit with the role each edit gives: u and a for insertions, U and A
    for new roles."""
    out, i, state = [], 0, entry
    for letter in audit:
        symbol = "" if letter == "I" else symbols[i]
        if letter == "K":
            state = AFTER[state, symbol.lower()]
        elif letter != "D":
            state = EXPECTED[state]
            letter = ("u" if state == USER else "a") if letter == "I" else ("U" if state == USER else "A")
        out.append(letter)
        i += symbol != ""
    return "".join(out)


def _paths(symbols: str, first: bool, last: bool) -> list[dict]:
    """The cheapest way between each entry and exit of a block, with the place
    of its audit among those of the block."""
    found = []
    for entry in (NONE,) if first else range(4):
        for exits in (FINAL,) if last else [(q,) for q in range(4)]:
            way = cheapest(symbols, entry, exits, closed=not last)
            if way:
                found.append((entry, exits[0], way[0], way[1], written_out(symbols, entry, way[1])))
    order = {audit: k for k, audit in enumerate(sorted({f[3] for f in found}))}
    return [{"entry": e, "exit": x, "cost": c, "place": order[a], "code": code} for e, x, c, a, code in found]


_remembered = lru_cache(maxsize=20_000)(_paths)
PATHS = "array<struct<entry:int,exit:int,cost:bigint,place:int,code:string>>"


def _search(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("place", pa.int32()), ("code", pa.string())]))
    for symbols, first, last in batches:
        yield pa.array([(_remembered if len(s) <= 64 else _paths)(s, f, t) for s, f, t in zip(*(x.to_pylist() for x in (symbols, first, last)))], type=kind)


def chain(blocks: list[list[dict]]) -> list[int]:
    """Index of the way taken through each block of a conversation. Behind
    each entry the least (cost, audit) is kept from the last block to the
    first; two ways with different exits differ before either audit ends."""
    behind, taken = dict.fromkeys(range(4), 0), []
    for ways in reversed(blocks):
        best: dict[int, tuple[int, int, int]] = {}
        for k, way in enumerate(ways):
            if way["exit"] in behind:
                label = (way["cost"] + behind[way["exit"]], way["place"], k)
                best[way["entry"]] = min(best.get(way["entry"], label), label)
        taken.append({entry: k for entry, (_, _, k) in best.items()})
        behind = {entry: cost for entry, (cost, _, _) in best.items()}
    state, out = NONE, []
    for ways, choice in zip(blocks, reversed(taken)):
        out.append(choice[state])
        state = ways[choice[state]]["exit"]
    return out


def _chain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for blocks in batches:
        yield pa.array([chain(b) for b in blocks.to_pylist()], type=pa.list_(pa.int32()))


# -- Spark ------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the CRC of
    ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 sets the role user. Null counts as one space,
    in the key, the role and the text alike."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")


def marked(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, new_turn, role, text, fault, illegal, symbol):
    the rows of a conversation counted from 1 by turn (nulls first; rows of one
    turn by role and text), the first fault of each (blank, duplicate,
    truncated or null), and whether its role may not follow the one before."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.repartition("conv_id")  # both windows read this one exchange
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    in_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "nth")
    rows = rows.withColumn("nth", F.row_number().over(same)).select(
        "*", F.row_number().over(in_turn).cast("bigint").alias("place"), F.lag("role").over(in_turn).alias("role_before"), F.lag("turn").over(in_turn).alias("turn_before"))
    written = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    fault = (F.when(written == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.right(written, F.lit(1)).isin(".", "!", "?"), "truncated"))
    rows = rows.withColumn("fault", fault)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return rows.select(
        "conv_id", "place", "turn", (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"), "role", "text", "fault",
        (F.col("role_before").isNotNull() & ~F.concat(F.substring("role_before", 1, 1), initial).isin("su", "ua", "au")).alias("illegal"),
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(symbol)).otherwise(symbol).alias("symbol"))


def edits(rows: DataFrame) -> DataFrame:
    """(conv_id, block, cost, code) of ``marked`` rows: the edits of each block
    of a conversation, written out."""
    search, choose = F.arrow_udf(_search, PATHS), F.arrow_udf(_chain, "array<int>")
    block = F.floor((F.col("place") - 1) / BLOCK)
    by_place = F.array_sort(F.collect_list(F.struct("place", "symbol")))
    strings = (rows.select("conv_id", block.alias("block"), "place", "symbol").groupBy("conv_id", "block")
               .agg(F.array_join(F.transform(by_place, lambda x: x["symbol"]), "").alias("symbols")))
    lengths = rows.groupBy("conv_id").agg(F.floor((F.max("place") - 1) / BLOCK).alias("last")).withColumnRenamed("conv_id", "id")
    flagged = strings.join(lengths, F.col("conv_id").eqNullSafe(F.col("id")))
    searched = stored(flagged.select("conv_id", "block", "last", search("symbols", F.col("block") == 0, F.col("block") == F.col("last")).alias("ways")), "ways")
    short = searched.where("last = 0").select("conv_id", "block", F.col("ways")[0].alias("way"))
    numbers = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost"), w["place"].alias("place")))
    long = searched.where("last > 0")
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("block", numbers.alias("ways")))), lambda b: b["ways"])
    taken = (long.groupBy("conv_id").agg(blocks.alias("blocks")).select(F.col("conv_id").alias("id"), choose("blocks").alias("taken"))
             .select("id", F.posexplode("taken").alias("at", "k")))
    long = long.join(taken, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("block") == F.col("at"))).select("conv_id", "block", F.get("ways", "k").alias("way"))
    return short.unionByName(long).select("conv_id", "block", "way.cost", "way.code")


def edited(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """(conv_id, place, part, role, text) of the repaired messages, in the
    order of place and part; all of a conversation are in one partition."""
    actions = codes.select("conv_id", "block", F.posexplode(F.regexp_extract_all("code", F.lit("([ua]*[KUAD]|[ua]+$)"), F.lit(1))).alias("at", "action"))
    actions = actions.select("conv_id", (F.col("block") * BLOCK + F.col("at") + 1).alias("place"), "action")
    both = rows.select("conv_id", "place", "role", "text").unionByName(actions, allowMissingColumns=True).repartition("conv_id")
    here = Window.partitionBy("conv_id", "place")
    both = both.select("conv_id", "place", "role", "text", F.max("action").over(here).alias("action"), F.max("role").over(here).alias("own"))
    both = both.where("text IS NOT NULL OR own IS NULL")  # the row with its action; insertions behind the last row stand alone

    def message(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), text.alias("text"))

    letter = F.regexp_extract("action", "([KUAD]?)$", 1)
    added = F.transform(F.regexp_extract_all("action", F.lit("([ua])"), F.lit(1)), lambda x: message(F.when(x == "u", "user").otherwise("assistant"), F.lit("")))
    role = F.when(letter == "U", "user").when(letter == "A", "assistant").otherwise(F.col("role"))
    own = F.when(letter.isin("K", "U", "A"), F.array(message(role, F.col("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    return both.select("conv_id", "place", F.posexplode(F.concat(added, own)).alias("part", "m")).select("conv_id", "place", "part", "m.role", "m.text")


def digests(messages: DataFrame, dealt: bool = False) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of each conversation in
    order, hashed as they stream by. ``dealt`` says that all messages of a
    conversation are in one partition already."""
    kind = messages.schema["conv_id"].dataType

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found):
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], type=own), pa.array([h.hexdigest() for _, h in found], type=pa.string())], ["conv_id", "sha256"])

        own, current = None, []
        for given in batches:
            own, found = given.schema.field("conv_id").type, []
            for i, line in zip(given.column(0).to_pylist(), given.column(1).to_pylist()):
                if current and current[0] == i:
                    current[1].update(b"\n")
                else:
                    found += [tuple(current)] if current else []
                    current = [i, hashlib.sha256()]
                current[1].update(line.encode())
            if found:
                yield batch(found)
        if current:
            yield batch([tuple(current)])

    lines = messages.select("conv_id", "place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = (lines if dealt else lines.repartition("conv_id")).sortWithinPartitions("conv_id", "place", "part").select("conv_id", "line")
    return lines.mapInArrow(hashed, f"conv_id {kind.simpleString()}, sha256 string")


class Repaired(NamedTuple):
    """``conversations``: one row each, with counts, cost and audit;
    ``messages``: the repaired rows."""
    conversations: DataFrame
    messages: DataFrame


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> Repaired:
    """Repair every conversation of (conv_id, turn, role, text) so that its
    role initials are nothing or ``s?(ua)+``, at the least cost.

    Keep costs 0, a new role user or assistant 1, Delete 2 (blank rows and
    repeated ones have to go), an inserted message without text 5, and a
    truncated row that stays 5 more. Of equal costs the audit (the edits'
    initials in order) that is least in ASCII order is taken.

    Conversations: conv_id, gaps (turns missing between the least and the
    greatest), blank, duplicate, truncated, illegal (rows whose role may not
    follow the one before), cost, audit, repaired_sha256. A null role or text
    counts as one space, rows with a null turn come first and do not count for
    gaps, a null conv_id is a conversation. Rows of one turn go by role and
    text, equal rows are duplicates but for the first. An empty text is blank;
    texts of any length are whole. An empty table gives no row. Other columns
    are not carried: inserted messages would have none. Every conv_id of
    ``ids`` is reported, with zeros, an empty audit and the hash of nothing if
    it has no row.
    """
    ship(conversations.sparkSession)
    rows = stored(marked(conversations), "turns")
    codes = edits(rows)
    messages = edited(rows, codes)
    count = {f: F.count_if(F.col("fault") == f) for f in ("blank", "duplicate", "truncated")}
    every = (rows.select("conv_id", "turn", "new_turn", "fault", "illegal")
             .unionByName(codes.select("conv_id", "cost", F.struct("block", F.translate("code", "uaUA", "IIRR").alias("audit")).alias("piece")), allowMissingColumns=True)
             .unionByName(digests(messages, dealt=True), allowMissingColumns=True))
    if ids is not None:
        every = every.unionByName(ids.select("conv_id"), allowMissingColumns=True)
    nothing = hashlib.sha256(b"").hexdigest()
    found = every.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[c.alias(f) for f, c in count.items()], F.count_if("illegal").alias("illegal"), F.coalesce(F.sum("cost"), F.lit(0)).cast("bigint").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["audit"]), "").alias("audit"),
        F.coalesce(F.max("sha256"), F.lit(nothing)).alias("repaired_sha256"))
    return Repaired(found, messages)
