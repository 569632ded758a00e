"""Conversation repair against enumerated edits and the SQL of the query."""

import hashlib
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from palisade.llm import conversations as cv
from palisade.llm import queries, sql

rng = random.Random(11)
FORM = re.compile(r"(s?(ua)+)?")


def enumerated(codes):
    """The cheapest (cost, audit) over all edits with at most two insertions between turns."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]

    def choices(code):
        yield 4, "D", ""
        if not code & cv.MUST_GO:
            more = 3 * bool(code & cv.CUT)
            yield more, "K", "suax"[code & 3]
            yield 3 + more, "R", "u"
            yield 3 + more, "R", "a"

    for way in itertools.product(*[choices(c) for c in codes]):
        for put in itertools.product(gaps, repeat=len(codes) + 1):
            roles = put[0] + "".join(w[2] + p for w, p in zip(way, put[1:], strict=True))
            if FORM.fullmatch(roles):
                audit = "I" * len(put[0]) + "".join(w[1] + "I" * len(p) for w, p in zip(way, put[1:], strict=True))
                found = (sum(w[0] for w in way) + 3 * sum(map(len, put)), audit)
                best = min(best or found, found)
    return best


def test_products_are_the_cheapest_edits():
    codes = [0, 1, 2, 3, 4, 9, 10, 11, 8]
    for n in range(4):
        for turns in itertools.product(codes, repeat=n) if n < 3 else [rng.choices(codes, k=3) for _ in range(60)]:
            assert cv.cheapest(cv.product(list(turns))) == enumerated(list(turns))


def test_products_are_associative():
    """However a conversation is cut, the result is the same."""
    for _ in range(40):
        codes = rng.choices(range(12), k=30)
        whole = cv.cheapest(cv.product(codes, False))
        cut = rng.randrange(31)
        assert cv.cheapest(cv.times(cv.product(codes[:cut], False), cv.product(codes[cut:]))) == whole
        mid = sorted(rng.sample(range(31), 2))
        a, b, c = cv.product(codes[: mid[0]]), cv.product(codes[mid[0] : mid[1]]), cv.product(codes[mid[1] :])
        assert cv.times(cv.times(a, b), c) == cv.times(a, cv.times(b, c))
        roles = ["suax"[c & 3] for c in codes]
        out = [x for part, state, edits in cv.pieces(whole[1], 4) for x in cv.apply(edits, state, roles[part * 4 : part * 4 + 4], [""] * 4)]
        assert FORM.fullmatch("".join(r[0] for r, _, _ in out))


ROLES = ["user", "assistant", "system", "tool", None, "", "u", "User"]
TEXTS = ["Yes.", "No", "", " \t", None, "Is it?  ", "Well!\n", "é.", "x" * 3000 + ".", "...", "a.b", "\x0b."]


def turns():
    for conv in [*range(40), None]:
        n = rng.choice([0, 1, 2, 3, 5, 9])
        for turn in range(n):
            yield conv, rng.choice([turn, turn * 2, None]) if conv and conv % 3 == 0 else turn, rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), rng.choice(TEXTS)
    for turn in range(150):  # one that many chunks share
        yield 77, turn, ("user", "assistant")[turn % 2], f"turn {turn % 90}."
    yield 78, -(2**62), "user", "Far."
    yield 78, 2**61, "assistant", "Far."
    for _ in range(6):
        yield 79, 4, "user", "Same."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("conversations"))
    rows = list(turns())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("pos", "n", "part", "copy", "task", "code", "fault", "chunk", "audit")})
    df.repartition(4).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize(("chunk", "fan"), [(128, 64), (4, 3), (1, 2)])
def test_query_against_sql(spark, folder, monkeypatch, chunk, fan):
    """Nulls, empty texts, other roles, gaps, ties, repeated rows; conversations of one chunk and of many."""
    plain = cv.repair
    monkeypatch.setattr(cv, "repair", lambda rows: plain(rows, chunk, fan))
    df = queries.op13_conversations(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    found = con.execute(sql.OP13)
    names = [c[0] for c in found.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in found.fetchall()), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0))
    got = sorted((r.asDict() for r in df.collect()), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0))
    assert got == want
    assert {type(r["audit"]) for r in got} == {str} and max(len(r["audit"]) for r in got) > 100


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi"), (1, 2, "user", "Hi"), (2, 0, "system", "Be short."), (2, 1, "user", " "), (3, 0, "user", "")]
    found = cv.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {}
    for r in found.turns().orderBy("conv_id", "chunk", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text, r.edit))
    summary = {r.conv_id: (r.cost, r.audit) for r in found.summary.collect()}
    assert got[1] == [("user", "", "I"), ("assistant", "Hello.", "K")] and summary[1] == (3 + 4 + 4, "IKDD")
    assert 2 not in got and summary[2] == (8, "DD") and 3 not in got
    digests = {r.conv_id: r.sha256 for r in found.digests.collect()}
    assert digests == {1: hashlib.sha256(b"user:\nassistant:Hello.").hexdigest(), 2: hashlib.sha256(b"").hexdigest(), 3: hashlib.sha256(b"").hexdigest()}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversations(spark, str(tmp_path)).collect() == []
