"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Everything is built-in expressions on the row: no shuffle, no Python.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows give repeated
results; a null id is kept. Only the id and text columns are read, so other columns cannot clash.
Positions count code points, ends are exclusive. Matches of one kind never overlap; kinds may.
"""

from pyspark.sql import functions as F

from hubbub.llm.shared import column, with_nulls_as_text

# Kind -> pattern, in the order kinds are listed. The quantifiers are possessive and
# runs are entered only at their start, which finds the same leftmost matches in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "short_card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# A text without this mark cannot hold the kind.
MARK = {"email": "@", "phone": "+"}
# Score of a confirmed match, words that raise it by RAISE when within NEAR characters, and the score a kind
# needs. Base kinds need none.
BASE = ("email", "ip", "card", "phone")
SCORE = {"email": 0.7, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "short_card": 0.4, "national_id": 0.3}
WORDS = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|master|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "short_card": "card|amex|american express|diners|credit|payment",
    "national_id": r"\bssn\b|social security|national id|identity",
}
NEEDED = {"short_card": 0.6, "national_id": 0.6}
RAISE, NEAR = 0.3, 40
# Positions of matches are summed in groups of this many, so a text with very many matches stays cheap.
GROUP = 256


def digits(match):
    return F.translate(match, " -", "")


def luhn(number):
    """The digits pass the Luhn checksum: every second one from the right counts double."""
    def value(i):
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def mod97(match):
    """The account number, its first four characters moved last and letters read as 10 to 35, leaves 1."""
    code = F.translate(match, " ", "")
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest, i):
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 65, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def confirmed(kind, match):
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind in ("card", "short_card"):
        low, high = (16, 19) if kind == "card" else (13, 15)
        number = digits(match)
        return F.when(F.length(number).between(low, high), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    return mod97(match) if kind == "iban" else F.lit(True)


def exclusive_sums(steps):
    """Running sums before each element, in groups: a group's start, then the few elements ahead in it."""
    add = lambda values: F.aggregate(values, F.lit(0), lambda a, x: a + x)
    starts = F.aggregate(
        F.sequence(F.lit(0), F.floor(F.size(steps) / GROUP).cast("int")), F.array(F.lit(0)),
        lambda sums, g: F.array_append(sums, F.element_at(sums, -1) + add(F.slice(steps, g * GROUP + 1, F.lit(GROUP)))),
    )
    return F.transform(steps, lambda _, i: F.get(starts, F.floor(i / GROUP).cast("int")) + add(F.slice(steps, i - i % GROUP + 1, i % GROUP)))


def near_word(kind, start, end):
    around = F.substring(F.col("text"), F.greatest(start - NEAR, F.lit(0)) + 1, end - start + 2 * NEAR)
    return F.lower(around).rlike(WORDS[kind])


def kind_spans(kind):
    """The kind's confirmed and well enough scored spans, from its matches and the pieces between them."""
    found, pieces, starts = F.col(f"m_{kind}"), F.col(f"p_{kind}"), F.col(f"s_{kind}")
    start = lambda i: F.get(starts, i) + F.length(F.get(pieces, i))
    spans = F.transform(found, lambda m, i: F.struct(F.lit(kind).alias("kind"), start(i).alias("start"), (start(i) + F.length(m)).alias("end"), m.alias("match")))
    spans = F.filter(spans, lambda s: confirmed(kind, s["match"]))
    spans = F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        (F.lit(SCORE[kind]) + F.when(near_word(kind, s["start"], s["end"]), F.lit(RAISE)).otherwise(F.lit(0.0))).alias("score"),
    ))
    if kind in NEEDED:
        spans = F.filter(spans, lambda s: s["score"] >= NEEDED[kind])
    return F.when(F.size(found) > 0, spans).otherwise(F.expr("array()").cast("array<struct<kind:string,start:int,end:int,score:double>>"))


def find(docs, id_col="doc_id", text_col="text"):
    """doc_id, text and ``spans``: array of (kind, start, end, score), by kind as listed, then start."""
    rows = with_nulls_as_text(docs, id_col, text_col)
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]"))
    none = F.expr("array()").cast("array<string>")

    def possible(kind):
        mark = F.contains(F.col("text"), F.lit(MARK[kind])) if kind in MARK else F.lit(True)
        return mark if kind == "email" else F.col("digit") & mark

    # One step each for matches, pieces and sums, so that none is computed twice.
    rows = rows.select("*", *[F.when(possible(k), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}") for k, p in PATTERNS.items()])
    rows = rows.select("*", *[F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).otherwise(none).alias(f"p_{k}") for k, p in PATTERNS.items()])
    steps = lambda k: F.transform(F.col(f"m_{k}"), lambda m, i: F.length(m) + F.length(F.get(F.col(f"p_{k}"), i)))
    rows = rows.select("*", *[steps(k).alias(f"t_{k}") for k in PATTERNS])
    rows = rows.select("*", *[F.when(F.size(f"m_{k}") > 0, exclusive_sums(F.col(f"t_{k}"))).alias(f"s_{k}") for k in PATTERNS])
    return rows.select("doc_id", "text", F.concat(*[kind_spans(k) for k in PATTERNS]).alias("spans"))


def listed(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found):
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs, id_col="doc_id", text_col="text"):
    """The documents with every span replaced by its kind in brackets; overlapping spans become one, named after
    the first. All other columns stay as they are; a null text stays null."""
    rows = docs.withColumn("__row", F.struct(*[column(docs, c) for c in docs.columns]))
    found = find(rows.select("__row", column(rows, text_col).alias("text")), "__row", "text")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    last = lambda out: F.element_at(out, -1)

    def merge(out, s):
        joined = F.struct(last(out)["start"].alias("start"), F.greatest(last(out)["end"], s["end"]).alias("end"), last(out)["kind"].alias("kind"))
        apart = (F.size(out) == 0) | (F.try_element_at(out, F.lit(-1))["end"] <= s["start"])
        return F.when(apart, F.array_append(out, s)).otherwise(F.array_append(F.slice(out, F.lit(1), F.size(out) - 1), joined))

    merged = F.aggregate(ordered, F.expr("array()").cast("array<struct<start:int,end:int,kind:string>>"), merge)
    found = found.select("doc_id", "text", F.when(F.size("spans") > 0, merged).alias("spans"))
    piece = lambda s, i: F.concat(
        F.substring("text", F.when(i == 0, 0).otherwise(F.get(F.col("spans"), i - 1)["end"]) + 1, s["start"] - F.when(i == 0, 0).otherwise(F.get(F.col("spans"), i - 1)["end"])),
        F.lit("["), F.upper(s["kind"]), F.lit("]"),
    )
    tail = F.substring("text", last(F.col("spans"))["end"] + 1, F.length("text"))
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform("spans", piece), ""), tail))
    new = found.select("doc_id", F.when(F.col("doc_id")[text_col].isNull(), F.lit(None).cast("string")).otherwise(clean).alias("clean"))
    return new.select(*[(F.col("clean") if c == text_col else F.col("doc_id")[c]).alias(c) for c in docs.columns])

