"""Conversation structure repair by the auction shortest-path algorithm.

A conversation's turns make a lattice: a node is a place between two turns together with what the roles so far allow
next (nothing yet, a system turn, a user's, an assistant's); an arc is an edit (delete, insert, keep, rerole) with an integer
cost. Each node has a price, at first a lower bound of the way to the end. The auction holds a path from an origin: where the
last node's price lies below the cheapest arc it is raised and the path contracts by one node, otherwise the path extends
along that arc, until it reaches a node whose price is known to be exact. Origins are taken from the end backwards, so paths
stay short, and in the end all prices are exact. Arcs whose cost is the difference of their nodes' prices are tight; following
the least letter among the tight arcs gives the ASCII-least of the cheapest audits.

Conversations are sorted once by ranges of (conversation, turn), so a long one lies in many partitions; they are cut into
segments of at most ``SEGMENT_ROWS`` turns. Of a conversation with several segments, each is first solved towards each way
of leaving it, then the auction runs over segments instead of turns (16 numbers each), which gives the exact prices at
their ends; with these all segments are traced at once, from each way of entering them. Only the hash of a repaired
conversation is one running sum: its texts stream through one task, of which a part is held at a time.

Defined results: null roles and texts are one space; null turns come first; a null conversation id names one conversation;
turns of equal number are ordered by role and the digest of the text; repeated rows stay and are duplicates. A row is blank without
a character other than white space, duplicate when its role and text came earlier, truncated when it ends otherwise than
with ``. ! ?``; the first of these counts. Roles that begin with other letters than s, u and a cannot be kept. An empty table gives
no rows. Only the four named columns are read, so others cannot clash.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hubbub.llm.shared import column, durable

SEGMENT_ROWS = 4096
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANKS = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
# A turn's code: its role's initial (x for any other); capital when truncated, a digit when it must be deleted.
WHOLE, CUT, DOOMED = "suax", "SUAX", "0123"
INITIAL = str.maketrans(CUT + DOOMED, WHOLE + WHOLE)
LEGAL = {"su", "ua", "au"}


def after(state):
    """The state that follows an inserted or reroled turn."""
    return ASSISTANT if state == USER else USER


def arcs_of(code, state):
    """(letter, cost, turns passed, next state) of a turn's edits, letters rising."""
    initial, more = code.translate(INITIAL), TRUNCATED if code in CUT else 0
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, after(state))]
    if code not in DOOMED:
        if initial == "ua"[after(state) - USER]:
            arcs.append(("K", more, 1, after(state)))
        elif initial == "s" and state == START:
            arcs.append(("K", more, 1, SYSTEM))
        arcs.append(("R", REROLE + more, 1, after(state)))
    return arcs


ARCS = {code: [arcs_of(code, state) for state in range(4)] for code in WHOLE + CUT + DOOMED}
# Behind the last turn only insertions are left; no letter leads to the end.
LAST = [([("", 0, 1, START)] if state in (START, ASSISTANT) else []) + [("I", INSERT, 0, after(state))] for state in range(4)]
LEAST = {code: min(cost for arcs in per_state for letter, cost, _, _ in arcs if letter != "I") for code, per_state in ARCS.items()}


def auction(price, exact, arcs, origin):
    """Raise prices until the path from ``origin`` reaches an exact one; all on the path are exact then.

    ``arcs(node)`` gives (cost, next node) of a node. No price may exceed an arc's cost plus the price at its end."""
    path = [origin]
    while not exact[path[-1]]:
        node = path[-1]
        cheapest, to = min((cost + price[to], to) for cost, to in arcs(node))
        if price[node] < cheapest:
            price[node] = cheapest
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)
    for node in path:
        exact[node] = True


def exact_prices(codes, ends):
    """Prices of the nodes (4 x place + state). ``ends`` holds the prices behind the last turn, or None at the real end."""
    n = len(codes)
    layers = [ARCS[c] for c in codes] + ([LAST] if ends is None else [])
    bound = 0 if ends is None else min(ends)
    price, exact = [bound] * (4 * len(layers)), [False] * (4 * len(layers))
    for i in range(n - 1, -1, -1):
        bound += LEAST[codes[i]]
        price[4 * i:4 * i + 4] = [bound] * 4
    price += [0] * 4 if ends is None else list(ends)
    exact += [True] * 4
    if ends is not None and FAR in ends:
        for i in range(n):
            for state in range(4):
                if unreachable(codes, i, state, ends):
                    price[4 * i + state], exact[4 * i + state] = FAR, True

    def arcs(node):
        i, state = divmod(node, 4)
        return [(cost, 4 * (i + passed) + to) for _, cost, passed, to in layers[i][state]]

    for origin in range(4 * len(layers) - 1, -1, -1):
        auction(price, exact, arcs, origin)
    return price, layers


def unreachable(codes, i, state, ends):
    """Whether no way leads from a node to the only open end."""
    goal = next(s for s in range(4) if ends[s] < FAR)
    if goal == START:
        return state != START
    if goal == SYSTEM:
        return state in (USER, ASSISTANT) or state == START and not ("s" in codes[i:] or "S" in codes[i:])
    return False


def through(codes):
    """Least cost from each state before the turns to each state behind them, FAR where there is no way."""
    columns = [exact_prices(codes, [0 if s == goal else FAR for s in range(4)])[0][:4] for goal in range(4)]
    return [min(FAR, columns[goal][state]) for state in range(4) for goal in range(4)]


def traced(codes, ends, states=(START,)):
    """(price, audit, state behind) of the cheapest, then least, way from each of ``states``."""
    price, layers = exact_prices(codes, ends)
    out = []
    for state in states:
        i, letters, entered = 0, [], state
        while i < len(layers):
            here = price[4 * i + state]
            letter, passed, state = next((letter, passed, to) for letter, cost, passed, to in layers[i][state] if cost + price[4 * (i + passed) + to] == here)
            i += passed
            letters.append(letter)
        out.append((price[entered], "".join(letters), state))
    return out


def illegal_pairs(codes):
    initials = codes.translate(INITIAL)
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


# --- rows ---------------------------------------------------------------------------------------

def damage(rows, names=("conv_id", "turn", "role", "text")):
    """The rows as a careless log would hold them: some are missing, emptied, without ends, twice, or all from the user."""
    conv, turn, role, text = (column(rows, n) for n in names)
    said = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")), F.lit(20))
    rows = rows.select(conv.alias(names[0]), turn.alias(names[1]), said(role).alias(names[2]), said(text).alias(names[3]), kind.alias("kind")).where("kind <> 0")
    role, text, kind = column(rows, names[2]), column(rows, names[3]), F.col("kind")
    times = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    changed = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    return rows.select(names[0], names[1], F.when(kind == 4, "user").otherwise(role).alias(names[2]), changed.alias(names[3]), times.alias("copy")).drop("copy")


def ordered(rows, names):
    """(conv, turn, role, text, tie, at, seg): ``at`` rises along each conversation, ``seg`` numbers its segments."""
    conv, turn, role, text = (column(rows, n) for n in names)
    rows = rows.select(conv.alias("conv"), turn.alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"))
    # The last key only spreads rows that are alike in all else.
    rows = rows.withColumn("tie", F.md5("text")).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("tie"), F.col("spread")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    rows = durable(rows.withColumn("at", F.monotonically_increasing_id()))
    # Row numbers restart below bit 33 in each partition, so no segment reaches beyond one.
    return rows.withColumn("seg", F.expr(f"at div {SEGMENT_ROWS}"))


def coded(rows):
    """(conv, turn, at, seg, code, blank, duplicate, truncated) of every row."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    slim = rows.select("conv", "turn", "at", "seg", "role", "tie", (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"))
    firsts = slim.groupBy("conv", "role", "tie").agg(F.min("at").alias("first")).select("first")
    slim = slim.join(firsts, F.col("at") == F.col("first"), "left")
    blank, again = F.col("blank"), ~F.col("blank") & F.col("first").isNull()
    cut = ~blank & ~again & F.col("open")
    place = F.coalesce(F.nullif(F.instr(F.lit(WHOLE[:3]), F.substring("role", 1, 1)) * (F.col("role") != "").cast("int"), F.lit(0)), F.lit(4))
    code = F.substring(F.when(blank | again, DOOMED).when(cut, CUT).otherwise(WHOLE), place, F.lit(1))
    return slim.select("conv", "turn", "at", "seg", code.alias("code"), *[f.cast("long").alias(n) for f, n in ((blank, "blank"), (again, "duplicate"), (cut, "truncated"))])


def same(a, b):
    return F.col(a).eqNullSafe(F.col(b))


def batch(lines, names, types):
    return pa.RecordBatch.from_arrays([pa.array([line[k] for line in lines], t) for k, t in enumerate(types)], names)


def planned(rows):
    """(conv, seg, entered, audit, price, illegal) of every segment of coded rows: the cheapest edits and the state before them."""
    conv = rows.schema["conv"].dataType.simpleString()
    segments = rows.groupBy("conv", "seg").agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("own"))
    segments = durable(segments.select("conv", "seg", F.array_join(F.transform("own", lambda s: s["code"]), "").alias("codes")))
    sizes = segments.groupBy("conv").agg(F.count("*").alias("n"), F.max("seg").alias("last")).withColumnRenamed("conv", "c")
    segments = segments.join(sizes, same("conv", "c")).select("conv", "seg", "codes", "n", (F.col("seg") == F.col("last")).alias("is_last"))

    def summed_up(batches):
        for b in batches:
            lines = [(through(c) if not last else [p for p, _, _ in traced(c, None, (0, 1, 2, 3))], c.translate(INITIAL)[::max(1, len(c) - 1)]) for c, last in zip(b.column("codes").to_pylist(), b.column("is_last").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("seg"), *batch(lines, ["through", "outer"], [pa.list_(pa.int64()), pa.string()]).columns], ["conv", "seg", "through", "outer"])

    def chained(batches):
        """Prices behind each segment, by the auction over segments."""
        for b in batches:
            where, lines = [], []
            for k, chain in enumerate(b.column("chain").to_pylist()):
                n = len(chain)
                price, exact = [0] * (4 * n - 4) + chain[-1]["through"], [False] * (4 * n - 4) + [True] * 4
                arcs = lambda node, chain=chain: [(chain[node // 4]["through"][4 * (node % 4) + to], 4 * (node // 4 + 1) + to) for to in range(4)]
                for origin in range(4 * n - 5, -1, -1):
                    price[origin] = min(price[4 * (origin // 4 + 1):][:4])
                    auction(price, exact, arcs, origin)
                for i, s in enumerate(chain):
                    where.append(k)
                    lines.append((s["seg"], price[4 * i + 4:4 * i + 8] or None, int(i > 0 and chain[i - 1]["outer"][-1] + s["outer"][0] not in LEGAL)))
            yield pa.RecordBatch.from_arrays([b.column("conv").take(pa.array(where, pa.int64())), *batch(lines, ["s", "ends", "joint"], [pa.int64(), pa.list_(pa.int64()), pa.int64()]).columns], ["c", "s", "ends", "joint"])

    several = segments.where("n > 1")
    summaries = several.select("conv", "seg", "codes", "is_last").mapInArrow(summed_up, f"conv {conv}, seg long, through array<long>, outer string")
    chains = summaries.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "through", "outer"))).alias("chain"))
    ends = chains.mapInArrow(chained, f"c {conv}, s long, ends array<long>, joint long")
    several = several.join(ends, same("conv", "c") & (F.col("seg") == F.col("s"))).select("conv", "seg", "codes", "n", "ends", "joint")
    alone = segments.where("n = 1").select("conv", "seg", "codes", "n", F.lit(None).cast("array<long>").alias("ends"), F.lit(0).cast("long").alias("joint"))

    def trace(batches):
        known = {}  # short conversations often look alike
        for b in batches:
            lines = []
            for codes, n, ends, joint in zip(*(b.column(c).to_pylist() for c in ("codes", "n", "ends", "joint"))):
                if n == 1 and codes in known:
                    ways = known[codes]
                else:
                    ways = traced(codes, ends, (0,) if n == 1 else (0, 1, 2, 3))
                    if n == 1 and len(codes) < 64 and len(known) < 10_000:
                        known[codes] = ways
                lines.append((n, illegal_pairs(codes) + joint, *map(list, zip(*ways))))
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("seg"), *batch(lines, ["n", "illegal", "prices", "audits", "behind"], types).columns], ["conv", "seg", "n", "illegal", "prices", "audits", "behind"])

    ways = durable(alone.union(several).mapInArrow(trace, f"conv {conv}, seg long, n long, illegal long, prices array<long>, audits array<string>, behind array<int>"))

    def followed(batches):
        """The state before each segment, from the first one on."""
        for b in batches:
            where, lines = [], []
            for k, chain in enumerate(b.column("chain").to_pylist()):
                state = START
                for s in chain:
                    where.append(k)
                    lines.append((s["seg"], state))
                    state = s["behind"][state]
            yield pa.RecordBatch.from_arrays([b.column("conv").take(pa.array(where, pa.int64())), *batch(lines, ["s", "entered"], [pa.int64(), pa.int32()]).columns], ["c", "s", "entered"])

    chains = ways.where("n > 1").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "behind"))).alias("chain"))
    entered = chains.mapInArrow(followed, f"c {conv}, s long, entered int")
    found = ways.where("n > 1").join(entered, same("conv", "c") & (F.col("seg") == F.col("s"))).drop("c", "s")
    found = ways.where("n = 1").withColumn("entered", F.lit(START)).unionByName(found)
    return found.select("conv", "seg", "entered", F.get("audits", "entered").alias("audit"), F.get("prices", "entered").alias("price"), "illegal")


def with_audits(rows, plan):
    """Rows and, ahead of each segment's rows, its audit."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = plan.select("conv", "seg", F.lit(0).cast("long").alias("at"), none("string").alias("role"), none("string").alias("text"), "entered", "audit")
    return heads.union(rows.select("conv", "seg", (F.col("at") + 1).alias("at"), "role", "text", none("int"), none("string")))


def edited(batches):
    """(conv, seg, audit of a segment that begins here or None, edit, role, text) of sorted ``with_audits``; dropped turns have no text."""
    conv = seg = None
    letters, at, state = "", 0, START

    def inserted():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            at, state = at + 1, after(state)
            yield conv, seg, None, "I", "assistant" if state == ASSISTANT else "user", ""

    for b in batches:
        for c, s, role, text, entered, audit in zip(*(b.column(k).to_pylist() for k in ("conv", "seg", "role", "text", "entered", "audit"))):
            if audit is not None:
                yield from inserted()
                conv, seg, letters, at, state = c, s, audit, 0, entered
                yield conv, seg, audit, None, None, None
                continue
            yield from inserted()
            letter, at = letters[at], at + 1
            if letter == "D":
                yield conv, seg, None, "D", role, None
                continue
            state = SYSTEM if letter == "K" and state == START and role.startswith("s") else after(state)
            yield conv, seg, None, letter, role if letter == "K" else "assistant" if state == ASSISTANT else "user", text
    yield from inserted()


def repaired(rows, names=("conv_id", "turn", "role", "text")):
    """conv_id, seg, pos, edit, role, text: the repaired conversations, turns ordered by (seg, pos)."""
    rows = ordered(rows, names)
    conv = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        held, pos, of = [], 0, None
        for c, s, audit, edit, role, text in edited(batches):
            if audit is not None:
                pos = 0
            elif text is not None:
                held.append((c, s, pos, edit, role, text))
                pos += 1
            if len(held) == 512:
                yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "seg", "pos", "edit", "role", "text"), h)) for h in held], arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "seg", "pos", "edit", "role", "text"), h)) for h in held], arrow)

    arrow = pa.schema([("conv_id", to_arrow_type(rows.schema["conv"].dataType)), ("seg", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    both = with_audits(rows, planned(coded(rows)))
    both = both.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at")
    return both.mapInArrow(run, f"conv_id {conv}, seg long, pos long, edit string, role string, text string")


def digests(rows, plan):
    """(conv, audit, repaired_sha256): whole audits and hashes, texts streaming by."""
    conv = rows.schema["conv"].dataType.simpleString()
    arrow = pa.schema([("conv", to_arrow_type(rows.schema["conv"].dataType)), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        name, audits, sha, first, out = None, [], None, True, []
        for c, _, audit, _, role, text in edited(batches):
            if audit is not None:
                if sha is None or c != name:
                    if sha is not None:
                        out.append({"conv": name, "audit": "".join(audits), "repaired_sha256": sha.hexdigest()})
                    name, audits, sha, first = c, [], hashlib.sha256(), True
                    if len(out) == 512:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out = []
                audits.append(audit)
            elif text is not None:
                sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if sha is not None:
            out.append({"conv": name, "audit": "".join(audits), "repaired_sha256": sha.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    both = with_audits(rows, plan).repartition("conv").sortWithinPartitions("conv", "seg", "at")
    return both.mapInArrow(run, f"conv {conv}, audit string, repaired_sha256 string")


def repair(original, rows, names=("conv_id", "turn", "role", "text")):
    """One row for each conversation of ``original``: the faults of its ``rows``, the cheapest edits and the hash of the result."""
    conv = column(original, names[0])
    rows = ordered(rows, names)
    codes = durable(coded(rows))
    plan = durable(planned(codes))
    counts = ["blank", "duplicate", "truncated"]
    turns = codes.groupBy("conv", "turn").agg(*[F.sum(c).alias(c) for c in counts])
    gaps = F.max("turn").cast("long") - F.min("turn") + 1 - F.count("turn")
    faults = turns.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in counts])
    costs = plan.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.min_by("price", "seg").alias("cost"))
    # Every conversation, then what is known of it; grouping puts null ids together.
    every = original.select(conv.alias("conv")).distinct()
    for part in (faults, costs, digests(rows, plan)):
        every = every.unionByName(part, allowMissingColumns=True)
    most = lambda c, default: F.coalesce(F.max(c), F.lit(default)).alias(c)
    numbers = ["gaps", *counts, "illegal", "cost"]
    whole = every.groupBy("conv").agg(*[most(c, 0) for c in numbers], most("audit", ""), most("repaired_sha256", hashlib.sha256().hexdigest()))
    return whole.select(F.col("conv").alias("conv_id"), *[F.col(c).cast("long") for c in numbers], "audit", "repaired_sha256")


def crc32_sql(text):
    """The checksum of an ASCII string."""
    bit = "lambda c, k: xor(c >> 1, 3988292384 * (c & 1))"
    eight = ", ".join(["0::bigint"] * 8)
    bytes_ = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {bytes_}), lambda r, b: list_reduce([xor(r, b), {eight}], {bit})), 4294967295)"


def step_sql(state):
    """(cost, audit) of the best way from a state ahead of a turn, before insertions."""
    then = after(state)
    way = lambda letter, cost, to: f"{{'c': b[{to + 1}].c + {cost}, 'a': '{letter}' || b[{to + 1}].a}}"
    kept = f"when initial = '{'ua'[then - USER]}' then {way('K', 'more', then)}"
    if state == START:
        kept += f" when initial = 's' then {way('K', 'more', SYSTEM)}"
    options = [way("D", 2, state), f"case when doomed then null {kept} end", f"case when not doomed then {way('R', 'more + 1', then)} end"]
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x is not null))"


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
with recursive c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations),
d as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role, case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(case when kind = 3 then [1, 2] else [1] end) as copy from c) where kind <> 0),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i, rtrim(text, {SPACES}) as said, left(role, 1) as initial from d),
f as (
  select *, said = '' as blank, said <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
    lag(initial) over (partition by conv_id order by i) || initial as pair from n),
t as (select *, blank or duplicate as doomed, not blank and not duplicate and right(said, 1) not in ('.', '!', '?') as truncated from f),
s as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, sum(blank::int) as blank, sum(duplicate::int) as duplicate, sum(truncated::int) as truncated,
    count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal from t group by conv_id),
w as (
  select conv_id, max(i) as k, [{{'c': 0::bigint, 'a': ''}}, {{'c': 10::bigint, 'a': 'II'}}, {{'c': 5::bigint, 'a': 'I'}}, {{'c': 0::bigint, 'a': ''}}] as b from t group by conv_id
  union all
  select conv_id, k - 1, [list_min([o[1], {{'c': u.c + 5, 'a': 'I' || u.a}}]), list_min([o[2], {{'c': u.c + 5, 'a': 'I' || u.a}}]), u, a] from (
    select conv_id, k, o, list_min([o[3], {{'c': o[4].c + 5, 'a': 'I' || o[4].a}}]) as u, list_min([o[4], {{'c': o[3].c + 5, 'a': 'I' || o[3].a}}]) as a from (
      select conv_id, k, [{', '.join(step_sql(s) for s in range(4))}] as o
      from (select w.conv_id, w.k, w.b, t.initial, t.doomed, case when t.truncated then 5 else 0 end as more
        from w join t on t.conv_id is not distinct from w.conv_id and t.i = w.k)))),
p as (select conv_id, b[1].c as cost, b[1].a as audit from w where k = 0),
e as (
  select conv_id, j, letter, sum((letter <> 'I')::int) over (partition by conv_id order by j) as i, sum((letter <> 'D')::int) over (partition by conv_id order by j) as q
  from (select conv_id, generate_subscripts(string_split(audit, ''), 1) as j, unnest(string_split(audit, '')) as letter from p)),
r as (
  select e.conv_id, e.j, letter, q, t.role, t.text, max((q = 1 and letter = 'K' and t.initial = 's')::int) over (partition by e.conv_id) as opened
  from e left join t on t.conv_id is not distinct from e.conv_id and t.i = e.i and letter <> 'I' where letter in ('I', 'K', 'R')),
m as (
  select conv_id, string_agg(case when letter = 'K' then role when (q - opened) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by j) as whole
  from r group by conv_id),
every as (select distinct conv_id from conversations)
select every.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from every left join s on s.conv_id is not distinct from every.conv_id left join p on p.conv_id is not distinct from every.conv_id left join m on m.conv_id is not distinct from every.conv_id
"""
