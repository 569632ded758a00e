"""Repair of conversations to the form (system)? (user assistant)*, by cheapest edits, and their measures.

What a turn may do is a 4 x 4 matrix over the states of that form (nothing yet,
after system, after user, after assistant). An entry is (cost, audit), the
cheapest edits that lead from one state to another and their initials; matrices
are multiplied in the semiring where sums are concatenations and the lesser pair
wins. Insertions are closed over on both sides of a turn. Equal costs over the
same turns never have one audit begin with the other, as what is longer by an
insertion costs more; so taking the lesser audit early is right, the product is
associative, and a conversation can be cut anywhere. It is cut to chunks of
CHUNK turns, whose products are multiplied in groups of FAN, level by level;
the whole audit is then cut again by chunk and applied to the turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._order import positioned

CHUNK = 128
#: Products multiplied by one group of the tree.
FAN = 64
#: Turns and bytes of text that one task holds.
TASK_TURNS, TASK_BYTES = 2048, 8 << 20
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user's and an assistant's turn can follow, and a system's.
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
INITIALS = "sua"
#: Codes of turns: their initial's place (3 for others), plus these.
MUST_GO, CUT = 4, 8
ELEMENT = (
    "n long, first_turn long, last_turn long, some_turn boolean, turns long, first_role string, last_role string, "
    "blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"
)

Entry = tuple[int, str] | None
Matrix = list[list[Entry]]


def times(a: list[list[Entry]], b: Matrix) -> list[list[Entry]]:
    """The min-plus product over (cost, audit)."""
    out = []
    for row in a:
        new: list[Entry] = [None] * 4
        for x, to in zip(row, b, strict=True):
            if x is not None:
                for j, y in enumerate(to):
                    if y is not None and (new[j] is None or (x[0] + y[0], x[1] + y[1]) < new[j]):
                        new[j] = (x[0] + y[0], x[1] + y[1])
        out.append(new)
    return out


def identity() -> Matrix:
    return [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


def _closure() -> Matrix:
    once = identity()
    for i, j in STEPS["u"] + STEPS["a"]:
        once[i][j] = (INSERT, "I")
    return times(times(once, once), once)


CLOSURE = _closure()


def turn_matrix(code: int) -> Matrix:
    """What a turn of this code allows, insertions before and after it included."""
    more, initial = TRUNCATED * bool(code & CUT), INITIALS[code & 3] if code & 3 < 3 else ""
    m: Matrix = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if not code & MUST_GO:
        choices = [((i, j), (REROLE + more, "R")) for i, j in STEPS["u"] + STEPS["a"]] + [(step, (KEEP + more, "K")) for step in STEPS.get(initial, ())]
        for (i, j), entry in choices:
            m[i][j] = min(entry, m[i][j] or entry)
    return times(times(CLOSURE, m), CLOSURE)


TURNS = [turn_matrix(code) for code in range(12)]


def product(codes: list[int], whole: bool = True) -> list[list[Entry]]:
    """The product of turns; whole: from all states, else from the start alone."""
    out = CLOSURE if whole else CLOSURE[:1]
    for code in codes:
        out = times(out, TURNS[code])
    return out


def cheapest(m: list[list[Entry]]) -> tuple[int, str]:
    """The cheapest way from the start to where a conversation may end."""
    return min(x for x in (m[0][START], m[0][ASSISTANT]) if x is not None)


def after(state: int, edit: str, initial: str) -> int:
    """The state that an edit of a turn with this role's initial leads to."""
    if edit == "D":
        return state
    if edit == "K" and initial == "s":
        return SYSTEM
    return ASSISTANT if state == USER else USER


def pieces(audit: str, size: int) -> Iterator[tuple[int, int, str]]:
    """(chunk, state before it, its edits) of a whole audit; insertions belong to the turn before them.

    Without its system turn a repaired conversation is of even length, so whether the first turn is one needs no look at it.
    """
    first = "s" if (len(audit) - audit.count("D")) % 2 else ""
    state, turn, begin, before = START, 0, 0, START
    for at, edit in enumerate(audit):
        if edit != "I":
            if turn and turn % size == 0:
                yield turn // size - 1, before, audit[begin:at]
                begin, before = at, state
            turn += 1
        state = after(state, edit, first if state == START else "")
    yield max(0, turn - 1) // size, before, audit[begin:]


def apply(edits: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str, str]]:
    """(role, text, edit) of what edits make of turns, from a state on; deleted turns are gone."""
    out, turn = [], 0
    for edit in edits:
        role, text = ("", "") if edit == "I" else (roles[turn], texts[turn])
        turn += edit != "I"
        new = after(state, edit, role[:1])
        if edit in "RI":
            role = "assistant" if new == ASSISTANT else "user"
        if edit != "D":
            out.append((role, text, edit))
        state = new
    return out


def _element(rows: dict[str, list], a: int, b: int) -> dict:
    """The element of turns a to b."""
    turns = [t for t in rows["turn"][a:b] if t is not None]
    initials = rows["initial"][a:b]
    m = product(rows["code"][a:b], rows["pos"][a] > 0)
    return {
        "n": b - a, "first_turn": turns[0] if turns else 0, "last_turn": turns[-1] if turns else 0, "some_turn": bool(turns),
        "turns": len(set(turns)), "first_role": initials[0], "last_role": initials[-1],
        **{k: sum(f == k for f in rows["fault"][a:b]) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(x + y not in ("su", "ua", "au") for x, y in zip(initials[:-1], initials[1:], strict=True)),
        "costs": [-1 if x is None else x[0] for row in m for x in row], "audits": [None if x is None else x[1] for row in m for x in row],
    }


def _matrix(element: dict) -> list[list[Entry]]:
    flat = [None if c < 0 else (c, t) for c, t in zip(element["costs"], element["audits"], strict=True)]
    return [flat[i : i + 4] for i in range(0, len(flat), 4)]


def _joined(x: dict, y: dict) -> dict:
    """The element of what x and then y cover."""
    m = times(_matrix(x), _matrix(y))
    some = x["some_turn"] and y["some_turn"]
    one = x if x["some_turn"] else y
    return {
        "n": x["n"] + y["n"], "first_turn": one["first_turn"], "last_turn": (y if y["some_turn"] else x)["last_turn"],
        "some_turn": x["some_turn"] or y["some_turn"], "turns": x["turns"] + y["turns"] - bool(some and x["last_turn"] == y["first_turn"]),
        "first_role": x["first_role"], "last_role": y["last_role"],
        **{k: x[k] + y[k] for k in ("blank", "duplicate", "truncated")},
        "illegal": x["illegal"] + y["illegal"] + (x["last_role"] + y["first_role"] not in ("su", "ua", "au")),
        "costs": [-1 if e is None else e[0] for row in m for e in row], "audits": [None if e is None else e[1] for row in m for e in row],
    }


def _same_runs(conv: list, part: list) -> list[tuple[int, int]]:
    cuts = [i for i in range(1, len(conv)) if conv[i] != conv[i - 1] or part[i] != part[i - 1]]
    return list(zip([0, *cuts], [*cuts, len(conv)], strict=True)) if conv else []


def _table(rows: list[dict], table: pa.Table, take: list[int], part: list[int]) -> pa.Table:
    kinds = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "first_role": pa.string(), "last_role": pa.string(), "some_turn": pa.bool_()}
    names = [x.split()[0] for x in ELEMENT.split(", ")]
    columns = {k: pa.array([r[k] for r in rows], kinds.get(k, pa.int64())) for k in names}
    return pa.table({"conv_id": table.column("conv_id").take(pa.array(take, pa.int64())), "part": pa.array(part, pa.int64())} | columns)


def _task(tasks: int, part: Column) -> Column:
    return F.pmod(F.xxhash64("conv_id", part), F.lit(tasks)).cast("int").alias("task")


@dataclass
class Repair:
    """summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation that has turns.

    repaired: conv_id, chunk, chunks (how many the conversation has), turns (array of role, text, edit), in order.
    """

    summary: DataFrame
    repaired: DataFrame

    def turns(self) -> DataFrame:
        """conv_id, chunk, place, role, text, edit: the repaired turns, in the order of chunk and place."""
        return self.repaired.select("conv_id", "chunk", F.posexplode("turns").alias("place", "x")).select("conv_id", "chunk", "place", "x.*")

    @cached_property
    def digests(self) -> DataFrame:
        """conv_id, sha256: of each conversation's repaired `role:text`, joined by line breaks. A long one is hashed chunk after chunk as they stream by."""
        line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
        bodies = self.repaired.select("conv_id", "chunk", "chunks", F.when(F.size("turns") > 0, F.array_join(line, "\n")).alias("body"))
        short = bodies.where("chunks = 1").select("conv_id", F.sha2(F.coalesce("body", F.lit("")), 256).alias("sha256"))
        kind = self.repaired.schema["conv_id"].dataType.simpleString()
        long = bodies.where("chunks > 1").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
        return short.union(long.select("conv_id", "body").mapInArrow(_stream, f"conv_id {kind}, sha256 string"))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: list = []  # conversation, hash, whether it has any turn

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([now[0], pa.array([now[1].hexdigest()])], ["conv_id", "sha256"])

    for batch in batches:
        ids = batch.column("conv_id")
        for i, (conv, body) in enumerate(zip(ids.to_pylist(), batch.column("body"), strict=True)):
            if not now or now[0][0].as_py() != conv:
                if now:
                    yield done()
                now = [ids.slice(i, 1), hashlib.sha256(), False]
            if body.is_valid:
                now[1].update(b"\n" * now[2] + body.as_py().encode())
                now[2] = True
    if now:
        yield done()


def faults(rows: DataFrame) -> DataFrame:
    """role and text without nulls (one space each), the text's digest, and what can be told of a turn alone: initial, blank, ending."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    inner = F.rtrim(text, F.lit(SPACES))
    end = F.substring(inner, -1, 1)
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"), F.substring(role, 1, 1).alias("initial"),
        (inner == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"),
    )


def repair(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> Repair:
    """Measures and cheapest repair of each conversation of rows (conv_id, turn, role, text).

    Turns are taken by turn (null first), of one turn by role and then by the text's digest; nulls in role and text read as
    one space. A turn's first fault counts: blank (nothing but ASCII white space), duplicate (role and text as of a turn
    before), truncated (doesn't end in `.`, `!` or `?`). Edits: keep (0), another role (3, user or assistant), delete (4;
    blank and duplicate turns have to go), insert an empty user's or assistant's turn (3); truncated turns that stay
    cost 3 more. Roles are told by their initials, whose sequence has to become (s?(ua)+)?; audit holds the edits'
    initials, of the cheapest ones the least. gaps: numbers missing between the least and the greatest turn. illegal:
    neighbours other than su, ua, au. A null conv_id is a conversation; an empty table has none. chunk and fan don't
    change results; an audit's size grows with its conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    placed = positioned(faults(rows), ("conv_id",), ("turn", "role", "digest"))
    # copies of a turn are counted where they are before they are shuffled; few are left to be looked up
    first = placed.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("c"), F.min("pos").alias("first")).where("c > 1")
    first = first.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    light = placed.drop("text")
    same = light["conv_id"].eqNullSafe(first["_conv"]) & (light["role"] == first["_role"]) & (light["digest"] == first["_digest"])
    light = light.join(first, same, "left").withColumn("duplicate", F.coalesce(F.col("pos") > F.col("first"), F.lit(False)))
    fault = F.when(F.col("blank"), "blank").when(F.col("duplicate"), "duplicate").when(F.col("cut"), "truncated")
    code = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    code = code + F.when(fault == "truncated", CUT).when(fault.isNotNull(), MUST_GO).otherwise(0)
    part = F.floor(F.col("pos") / chunk).cast("long")
    n_turns, n_bytes, most = placed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()

    def fold(_: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
        columns = {c: table.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "initial", "fault", "code")}
        parts = [p // chunk for p in columns["pos"]]
        runs = _same_runs(columns["conv_id"], parts)
        return _table([_element(columns, a, b) for a, b in runs], table, [a for a, _ in runs], [parts[a] for a, _ in runs])

    def reduce(_: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("conv_id", "ascending"), ("part", "ascending")])
        elements, conv = table.drop_columns(["conv_id", "task"]).to_pylist(), table.column("conv_id").to_pylist()
        parts = [e["part"] // fan for e in elements]
        out, runs = [], _same_runs(conv, parts)
        for a, b in runs:
            x = elements[a]
            for y in elements[a + 1 : b]:
                x = _joined(x, y)
            out.append(x)
        return _table(out, table, [a for a, _ in runs], [parts[a] for a, _ in runs])

    schema = f"conv_id {kind}, part long, {ELEMENT}"
    light = light.select("conv_id", "pos", "turn", "initial", fault.alias("fault"), code.alias("code"), _task(max(1, -(-n_turns // TASK_TURNS)), part))
    elements = light.groupBy("task").applyInArrow(fold, schema)
    longest = -(-most // chunk)
    while longest > 1:  # conversations of one chunk pass through as they are
        elements = _plan.stored(elements, "conversation-products")
        tasks = max(1, -(-elements.count() // TASK_TURNS))
        elements = elements.withColumn("task", _task(tasks, F.floor(F.col("part") / fan).cast("long"))).groupBy("task").applyInArrow(reduce, schema)
        longest = -(-longest // fan)
    summary = _plan.stored(_summary(elements, kind), "conversations")
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, out = [], []
            for i, audit in enumerate(batch.column("audit").to_pylist()):
                got = list(pieces(audit, chunk))
                take += [i] * len(got)
                out += got
            part, state, edits = map(list, zip(*out, strict=True)) if out else ([], [], [])
            columns = [batch.column("conv_id").take(pa.array(take, pa.int64())), pa.array(part, pa.int64()), pa.array(state, pa.int32()), pa.array(edits, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "state", "edits"])

    turn = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def mend(_: tuple, mine: pa.Table, audits: pa.Table) -> pa.Table:
        mine = mine.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
        known = {(c, p): (s, e) for c, p, s, e in zip(*[audits.column(x).to_pylist() for x in ("conv_id", "part", "state", "edits")], strict=True)}
        conv, pos, roles, texts = (mine.column(x).to_pylist() for x in ("conv_id", "pos", "role", "text"))
        parts = [p // chunk for p in pos]
        runs, out = _same_runs(conv, parts), []
        for a, b in runs:
            state, edits = known[conv[a], parts[a]]
            out.append([{"role": r, "text": t, "edit": e} for r, t, e in apply(edits, state, roles[a:b], texts[a:b])])
        first = pa.array([a for a, _ in runs], pa.int64())
        size = [-(-n // chunk) for n in mine.column("n").take(first).to_pylist()]
        return pa.table({"conv_id": mine.column("conv_id").take(first), "chunk": pa.array([parts[a] for a, _ in runs], pa.int64()), "chunks": pa.array(size, pa.int64()), "turns": pa.array(out, pa.list_(turn))})

    tasks = max(1, -(-n_turns // TASK_TURNS), -(-n_bytes // TASK_BYTES))
    cuts = summary.select("conv_id", "audit").mapInArrow(cut, f"conv_id {kind}, part long, state int, edits string")
    cuts = cuts.withColumn("task", _task(tasks, F.col("part")))
    texts = placed.select("conv_id", "pos", "n", "role", "text", _task(tasks, part))
    repaired = texts.groupBy("task").cogroup(cuts.groupBy("task")).applyInArrow(mend, f"conv_id {kind}, chunk long, chunks long, turns array<struct<role:string,text:string,edit:string>>")
    return Repair(summary.drop("n"), _plan.stored(repaired, "repaired"))


def _summary(elements: DataFrame, kind: str) -> DataFrame:
    """One row a conversation, of its one element."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"costs": c, "audits": a} for c, a in zip(batch.column("costs").to_pylist(), batch.column("audits").to_pylist(), strict=True)]
            best = [cheapest(_matrix(r)) for r in rows]
            columns = {c: batch.column(c) for c in ("conv_id", "n", "first_turn", "last_turn", "some_turn", "turns", "blank", "duplicate", "truncated", "illegal")}
            yield pa.RecordBatch.from_pydict(columns | {"cost": pa.array([b[0] for b in best], pa.int64()), "audit": pa.array([b[1] for b in best], pa.string())})

    rows = elements.mapInArrow(run, f"conv_id {kind}, n long, first_turn long, last_turn long, some_turn boolean, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    gaps = F.when(F.col("some_turn"), F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).otherwise(F.lit(0)).cast("long")
    return rows.select("conv_id", "n", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
