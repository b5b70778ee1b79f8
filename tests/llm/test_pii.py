import hashlib
import re

from hubbub.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def confirmed(kind, match):
    number = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 16 <= len(number) <= 19 and luhn(number), "phone": lambda: 8 <= len(number) <= 15,
    }[kind]()


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if confirmed(k, m[0])]


def check(rows, got):
    want = sorted((str(i), hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in got) == want


def test_base_spans_of_dirty_rows(frame, dirty):
    tricky = [
        "a@b.c%d@e.f g..h@i.j", "1.2.3.4.5.6.7.8", "00255.1.1.1 256.1.1.1", "4111-1111-1111-1111 4111111111111112", "++1 (2) 3 +12345678 +1-",
        "@a.b", "a@b-%c@d.e", "1" * 3000, "a@b.c " * 700, "😀 a@b.cé", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "a" * 60_000,
    ]
    rows = [*dirty, *[(100 + i, t) for i, t in enumerate(tricky)]]
    check(rows, pii.digest(pii.find(frame(rows))).collect())


def test_many_matches_keep_their_places(frame):
    rows = [(1, " ".join(f"u{i}@mail{i}.example.com" for i in range(1500)))]
    check(rows, pii.digest(pii.find(frame(rows))).collect())


def test_method_adds_spans(frame):
    rows = [(1, "account GB82 WEST 1234 5698 7654 32 here"), (2, "GB83 WEST 1234 5698 7654 32"), (3, "ssn 123-45-6789"), (4, "no 123-45-6789"), (5, "amex card 378282246310005"), (6, "number 378282246310005")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(frame(rows))).collect()}
    assert got == {1: "iban:8:35", 2: "", 3: "national_id:4:15", 4: "", 5: "short_card:10:25", 6: ""}


def test_context_raises_score(frame):
    rows = [(1, "mail a@b.c"), (2, "see a@b.c")]
    got = {r["doc_id"]: r["spans"][0]["score"] for r in pii.find(frame(rows)).collect()}
    assert got[1] > got[2]


def test_redact(frame, dirty):
    rows = [*dirty, (50, "x a@b.cd, 4111111111111111!"), (51, "card 378282246310005 end")]
    docs = frame(rows)
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    got = clean.collect()
    texts = {r["doc_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and texts[50] == "x [EMAIL], [CARD]!" and texts[51] == "card [SHORT_CARD] end" and texts[0] is None and texts[1] == ""
    assert texts[16] == "mail [EMAIL] or [CARD] now, call [PHONE], host [IP] and 1.2.3.999"
    assert all(r["__row"] == "x" for r in got)


def test_empty_table(frame):
    assert pii.digest(pii.find(frame([]))).collect() == [] and pii.redact(frame([])).collect() == []


def test_no_python_and_no_shuffle(frame, dirty):
    plan = pii.digest(pii.find(frame(dirty)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
