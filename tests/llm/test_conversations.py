import hashlib
import random
import zlib
from functools import lru_cache

from adpulse.llm import conversations as conv
from adpulse.llm import queries

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def plain(symbols):
    """Cheapest edits by recursion on the rest of the rows, at most three insertions in a place."""
    @lru_cache(None)
    def best(i, state, inserted):
        due = "a" if state == "u" else "u"
        found = [(0, "")] if i == len(symbols) and state in ("", "a") else []
        if i < len(symbols):
            c, t = best(i + 1, state, 0)
            found.append((c + 2, "D" + t))
            extra = 5 * symbols[i].isupper()
            for letter, cost, after in (("R", 1, due), ("K", 0, symbols[i].lower())):
                if symbols[i] != "x" and (letter == "R" or after == due or after == "s" and state == ""):
                    c, t = best(i + 1, after, 0)
                    found.append((c + cost + extra, letter + t))
        if inserted < 3:
            c, t = best(i, due, inserted + 1)
            found.append((c + 5, "I" + t))
        return min(found, default=(10 ** 9, ""))
    return best(0, "", 0)


def brute(table):
    """The contract's result for (conv_id, turn, role, text) rows, in plain Python."""
    out = {}
    for cid in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == cid):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if cid is None else cid}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, faults = set(), "", []
        for _, role, text in rows:
            fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(WHITE)[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            one = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else one.upper() if fault else one
        cost, audit = plain(symbols)
        said, state, left = [], "", iter(rows)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(left)[1:]
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            said.append(f"{role}:{text}")
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        out[cid] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_search_and_chained_blocks_against_recursion():
    rng = random.Random(1)
    for _ in range(1500):
        symbols = "".join(rng.choice(rng.choice(["uaxsoUASO", "uaua", "uaxUA", "so", "uuua"])) for _ in range(rng.randrange(1, 13)))
        want = plain(symbols)
        assert conv.cheapest(symbols, conv.NONE, conv.FINAL, closed=False) == want
        for size in (1, 2, 4):
            parts = [symbols[k:k + size] for k in range(0, len(symbols), size)]
            ways = [conv._paths(b, k == 0, k == len(parts) - 1) for k, b in enumerate(parts)]
            taken = [w[k] for w, k in zip(ways, conv.chain(ways))]
            assert (sum(w["cost"] for w in taken), "".join(w["code"] for w in taken).translate(str.maketrans("uaUA", "IIRR"))) == want


def test_registered_query_against_plain_version(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_conversations(spark, SF)) == brute(table)


ODD = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "No end"), (1, None, None, None), (1, None, "system", "Be good."),
       (2, 5, "tool", "x" * 200_000 + "."), (2, 9, "assistant", "Yes!\n\t "), (2, 7, "", "What?"), (3, 1, "user", ""), (3, 2, "user", " \n\x0b"),
       (None, 1, "assistant", "Lost."), (None, None, "user", "é日本 \U0001F600."), (4, None, "user", None), (5, 3, "assistant", "One."), (5, 3, "user", "Two."),
       (5, 3, "user", "Two."), (6, 2, "system", "Only this."), (7, 1, "s", "a?"), (7, 2, "user", "b."), (7, 3, "user", "c"), (7, 4, "user", "d!")]


def test_odd_rows_and_extra_columns(spark):
    schema = "conv_id long, turn long, role string, text string, place string, audit long, block string, symbol int, sha256 string"
    df = spark.createDataFrame([(*r, "in", 1, None, 2, "in") for r in ODD], schema).repartition(3)
    assert found(conv.repair(conv.damaged(df), ids=df).conversations) == brute(ODD)
    strings = df.withColumn("conv_id", df.conv_id.cast("string"))
    want = {None if k is None else str(k): v for k, v in brute(ODD).items()}
    assert found(conv.repair(conv.damaged(strings), ids=strings).conversations) == want


def test_long_conversations_in_blocks(spark, monkeypatch):
    """A hot conversation that holds a third of all rows is searched block by block."""
    monkeypatch.setattr(conv, "BLOCK", 16)
    rng = random.Random(3)
    texts = ["Yes.", "No", "Why?", "", "Go on."]
    table = [(0, k, rng.choice(["user", "assistant", "system"]), rng.choice(texts) if k % 3 else f"Line {k}.") for k in range(300)]
    table += [(1 + k // 6, k % 6, "user" if k % 2 == 0 else "assistant", f"Text {k}.") for k in range(600)]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(4)
    got = conv.repair(conv.damaged(df), ids=df)
    assert found(got.conversations) == brute(table)
    messages = got.messages.where("conv_id = 0").orderBy("place", "part").collect()
    assert [m.role[:1] for m in messages][-1] == "a" and "".join(m.role[:1] for m in messages).lstrip("s").replace("ua", "") == ""
    again = {r.conv_id: r.sha256 for r in conv.digests(got.messages.repartition(7)).collect()}
    assert all(again[i] == row[-1] for i, row in brute(table).items() if i in again)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    repaired = conv.repair(conv.damaged(none), ids=none)
    assert repaired.conversations.count() == 0 and repaired.messages.count() == 0
    one = spark.createDataFrame([(4, None, None, None)], none.schema)
    assert found(conv.repair(none, ids=one).conversations) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


