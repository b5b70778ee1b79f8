import duckdb
import pytest

from hubbub.llm import chat

ROWS = [
    # 1 is a snapshot of 2; 3 equals 2; 4 differs in its second turn; 5 shares only the first turn.
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "more"),
    (4, 0, "user", "hi"), (4, 1, "user", "hello"), (5, 0, "user", "hi"), (5, 1, "assistant", "bye"),
    # gaps, repeated rows, nulls, marks, ties, empty texts; the order of turns counts
    (6, 3, "user", "late"), (6, 10, None, None), (6, 10, None, None), (7, None, "user", "a"), (7, 0, "user", "b"),
    (8, 0, "user", "<|im_end|> x <|im_start|>"), (9, 1, "b", "x"), (9, 1, "a", "y"), (9, 1, "a", "x"),
    (None, 0, "user", "nobody"), (None, 1, "user", "here"), (10, 0, "user", "nobody"), (11, 0, "", ""),
    (12, 0, "user", "b"), (12, 1, "user", "a"),
]
SCHEMA = "conv_id long, turn long, role string, text string, conv string, part string, pos string, n string"


def plain(rows):
    """By comparing whole lists of turns."""
    import hashlib

    talks = {}
    for c, t, r, x in sorted({(c, t, r or "", x or "") for c, t, r, x in rows}, key=lambda k: (k[1] is not None, k[1] or 0, k[2], hashlib.md5(k[3].encode()).hexdigest())):
        talks.setdefault(c, []).append((r, x))
    kept = []
    for c, own in talks.items():
        continued = any(len(o) > len(own) and o[:len(own)] == own for o in talks.values())
        twins = [d for d, o in talks.items() if o == own]
        if not continued and c == min(twins, key=lambda d: (d is not None, d or 0)):
            clean = lambda s: s.replace(chat.OPEN, "<| im_start |>").replace(chat.CLOSE, "<| im_end |>")
            kept.append((c, len(own), "".join(f"{chat.OPEN}{clean(r)}\n{clean(x)}{chat.CLOSE}\n" for r, x in own)))
    return sorted(kept, key=str)


def talk(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return chat.collapse(frame, **options).collect()


def test_dirty_rows(spark):
    got = talk(spark, ROWS)
    assert sorted([(r["conv_id"], r["n_turns"], r["rendered"]) for r in got], key=str) == plain(ROWS)
    assert all(r["part"] == 0 for r in got)


def test_long_conversation_in_parts(spark):
    rows = ROWS + [(77, t, "user", f"turn {t} " + "x" * (t % 7)) for t in range(3000)] + [(78, t, "user", f"turn {t} " + "x" * (t % 7)) for t in range(2500)]
    got = {}
    for r in sorted(talk(spark, rows, part_chars=500), key=lambda r: r["part"]):
        got.setdefault((r["conv_id"], r["n_turns"]), []).append(r["rendered"])
    assert sorted([(*k, "".join(v)) for k, v in got.items()], key=str) == plain(rows)
    assert len(got[77, 3000]) > 100 and max(map(len, got[77, 3000])) < 600


def test_sql_agrees(spark):
    rows = [r for r in ROWS if r[0] is not None]
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = sorted((c, p, n, r) for c, p, n, r in db.execute(f"select conv_id, part, n_turns, rendered from ({chat.SQL})").fetchall())
    assert sorted((r["conv_id"], r["part"], r["n_turns"], r["rendered"]) for r in talk(spark, rows)) == want


def test_empty_table(spark):
    assert talk(spark, []) == []


@pytest.mark.parametrize("copies", [1, 3])
def test_repeated_rows_count_once(spark, copies):
    assert sorted(map(str, talk(spark, ROWS * copies))) == sorted(map(str, talk(spark, ROWS)))
