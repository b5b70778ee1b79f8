import hashlib
import random
import sys
import zlib

import duckdb
import pytest
from pyspark.sql import types as T

from hubbub.llm import structure

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("conv", "seg", "at", "code", "tie", "n", "kind")],
])
SPACE = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_ways(turns):
    """(cost, audit, outputs) by trying all edits with memory; ``turns`` are (role, text, doomed, truncated)."""
    kept = {}

    def best(i, opened, last, inserted):
        """``last`` is the last initial put out, or None."""
        if (i, opened, last, inserted) in kept:
            return kept[i, opened, last, inserted]
        wanted = "a" if last == "u" else "u"
        options = [(0, "")] if i == len(turns) and last in (None, "a") else []
        if inserted < 2:
            cost, audit = best(i, True, wanted, inserted + 1)
            options.append((cost + 5, "I" + audit))
        if i < len(turns):
            role, _, doomed, truncated = turns[i]
            cost, audit = best(i + 1, opened, last, 0)
            options.append((cost + 2, "D" + audit))
            if not doomed:
                for letter, initial, price in (("K", role[:1], 0), ("R", wanted, 1)):
                    if initial == wanted or letter == "K" and initial == "s" and not opened:
                        cost, audit = best(i + 1, True, initial, 0)
                        options.append((cost + price + 5 * truncated, letter + audit))
        kept[i, opened, last, inserted] = min(options, default=(10**9, ""))
        return kept[i, opened, last, inserted]

    return best(0, False, None, 0)


def plain(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        turns, seen, faults = [], set(), [0, 0, 0]
        for _, _, role, text in own:
            said = text.rstrip(SPACE)
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            turns.append((role, text, fault in (0, 1), fault == 2))
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = plain_ways(turns) if turns else (0, "")
        said, i, last = [], 0, None
        for letter in audit:
            role, text = ("", "") if letter == "I" else turns[i][:2]
            i += letter != "I"
            if letter != "D":
                wanted = "a" if last == "u" else "u"
                role = role if letter == "K" else {"u": "user", "a": "assistant"}[wanted]
                said.append(f"{role}:{text}")
                last = role[:1]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def talks(n, seed, longest=12):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = pick.randrange(3)
        for _ in range(pick.randrange(1, longest)):
            role = pick.choice(["user", "assistant", "system", "user", "assistant", "tool", ""])
            rows.append((conv, turn, role, pick.choice(["Hi.", "Yes!", "no", " \t", "", "Well?  ", "a. b", f"Text {pick.randrange(9)}."])))
            turn += pick.choice([1, 1, 1, 2, 5])
    return rows


ODD = [
    (None, 0, "user", "Who?"), (None, 1, "assistant", "Me."), (None, None, None, None), (900, None, "system", "S."), (900, None, "user", "U."), (900, 3, None, "x"),
    (901, 5, "user", "Same."), (901, 5, "user", "Same."), (901, 5, "assistant", "Other."), (902, -4, "assistant", None), (902, 9, "umbrella", "Long " * 5000 + "."),
    (903, 1, "assistant", "First."), (904, 0, "system", "Only."), (905, 0, "user", "No end"), (906, 1, "system", "a."), (906, 2, "system", "b."), (906, 3, "system", "c."),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA)


def found(spark, rows, damaged=True):
    own = frame(spark, rows)
    return sorted((tuple(r) for r in structure.repair(own, structure.damage(own) if damaged else own).collect()), key=str)


@pytest.mark.parametrize("segment", [4096, 3])
def test_same_as_trying_all_edits(spark, monkeypatch, segment):
    monkeypatch.setattr(structure, "SEGMENT_ROWS", segment)
    rows = talks(60, segment) + ODD
    assert found(spark, rows) == plain(rows, plain_damage(rows))


def test_undamaged_rows(spark, monkeypatch):
    monkeypatch.setattr(structure, "SEGMENT_ROWS", 2)
    rows = [(c, t, r or " ", " " if x is None else x) for c, t, r, x in talks(40, 7, 30) if r] + [(901, 5, "user", "Same.")] * 4 + [(902, 1, "assistant", "A.")] * 5
    assert found(spark, rows, damaged=False) == plain(rows, rows)


def test_conversations_of_which_nothing_is_left(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(lost, 0, "user", "Hi.")]) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert found(spark, []) == []


def test_long_conversation(spark, monkeypatch, request):
    """One conversation with most rows lies in many partitions and segments."""
    monkeypatch.setattr(structure, "SEGMENT_ROWS", 16)
    limit = sys.getrecursionlimit()
    request.addfinalizer(lambda: sys.setrecursionlimit(limit))
    sys.setrecursionlimit(10_000)
    pick = random.Random(5)
    rows = [(1, t, pick.choice(["user", "assistant", "system"]), pick.choice(["Yes.", "no", f"Text {t}.", ""])) for t in range(400)] + talks(10, 2)
    assert found(spark, rows) == plain(rows, plain_damage(rows))


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(structure, "SEGMENT_ROWS", 4)
    rows = [r for r in talks(30, 11, 20)]
    own = structure.damage(frame(spark, rows))
    said = {}
    for r in sorted(structure.repaired(own).collect(), key=lambda r: (r["conv_id"], r["seg"], r["pos"])):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "IKR" and (r["edit"] != "I" or r["text"] == "")
    want = {r[0]: r[8] for r in plain(rows, plain_damage(rows))}
    assert {c: hashlib.sha256("\n".join(said.get(c, [])).encode()).hexdigest() for c in want} == want


def test_prices_are_exact():
    """Every node's price is the least cost from there on, for a real end, given ends and single goals."""
    pick = random.Random(3)
    for _ in range(200):
        codes = "".join(pick.choice("suaxSUAX0123ua") for _ in range(pick.randrange(1, 9)))
        for ends in (None, [pick.randrange(9) for _ in range(4)], *[[0 if s == g else structure.FAR for s in range(4)] for g in range(4)]):
            price, layers = structure.exact_prices(codes, ends)
            want = [structure.FAR] * (4 * len(layers)) + ([0] * 4 if ends is None else list(ends))
            for _ in range(3 * len(layers) + 6):  # until nothing changes
                for node in range(4 * len(layers)):
                    i, state = divmod(node, 4)
                    want[node] = min([want[node]] + [c + want[4 * (i + p) + to] for _, c, p, to in layers[i][state]])
            assert [min(p, structure.FAR) for p in price] == [min(w, structure.FAR) for w in want]


def test_sql_agrees(spark):
    rows = [(c, t, r, x) for k, (c, t, r, x) in enumerate(talks(50, 21) + ODD)]
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn integer, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", [list(r) for r in rows])
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    assert found(spark, rows) == sorted(db.execute(f"select {names} from ({structure.SQL})").fetchall(), key=str)
