"""Many terms at once, and values held against texts, compared with plain loops."""

import random
import re

from pyspark.sql import functions as F

from palisade.operators import dictionary, validate

rng = random.Random(9)


def plain(texts, terms, whole):
    out = set()
    for key, text in texts:
        low = (text or "").lower()
        for t in {t.lower() for t in terms if t}:
            places = [i for i in range(len(low) - len(t) + 1) if low.startswith(t, i)]
            if whole:
                places = [i for i in places if not (i and low[i - 1].isalnum()) and not (i + len(t) < len(low) and low[i + len(t)].isalnum())]
            if places:
                out.add((key, t, len(places), places[0] + 1))
    return out


def rows(df):
    got = [(r.doc_id, r.term, r.n, r.first) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_terms_against_a_plain_loop(spark):
    """Overlaps, terms inside terms, case, other scripts, nulls and empties; one automaton and several."""
    texts = [(1, "Banana bandana ANA"), (2, None), (3, ""), (4, "Ünïcode straße, naïve; ana."), (5, "aaaa"), (None, "no id ana")]
    terms = ["ana", "ANA", "an", "banana", "band", "", None, "straße", "naïve", "a", "aa", "missing", "naïve; ana"]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"key": F.lit("clash"), "term": F.lit("clash")})
    words = spark.createDataFrame([(t,) for t in terms], "term string")
    for whole in (False, True):
        for size in (dictionary.TERM_BYTES, 100):
            assert rows(dictionary.term_matches(docs, words, whole_words=whole, term_bytes=size)) == plain(texts, terms, whole)
    assert dictionary.term_matches(docs, words.limit(0)).collect() == []
    weighted = words.withColumn("weight", F.when(F.col("term") == "band", 2.0))
    assert {(r.doc_id, r.score) for r in dictionary.gate(docs, weighted, 6).collect()} == {(1, 6.0), (4, 6.0)}


def test_fifty_thousand_terms(spark):
    letters = "abcdefgh"
    terms = list({"".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(60_000)})[:50_000]
    texts = [(i, "".join(rng.choices(letters + " ", k=3000))) for i in range(20)]
    got = rows(dictionary.term_matches(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(t,) for t in terms], "term string")))
    known, want = set(terms), set()
    for key, text in texts:
        counts = {}
        for n in range(4, 10):
            for i in range(len(text) - n + 1):
                if text[i : i + n] in known:
                    counts.setdefault(text[i : i + n], []).append(i)
        want |= {(key, t, len(p), p[0] + 1) for t, p in counts.items()}
    assert got == want and len(want) > 1000


def held(source, field, value):
    """The rule, written out."""
    src, v = source.lower(), value.strip(" ").lower()
    opened = validate._open(src)
    ok = any(x in t for x in (v, validate._open(v)) for t in (src, opened)) or re.sub(r"(\w)\.(\w)", r"\1[.]\2", v, flags=re.ASCII) in src
    if not ok and validate.by_windows(field, value):
        ok = any(w in src or w in opened for w in validate.windows(v))
    return ok


def test_values_against_a_plain_loop():
    source = "Run C:\\Tools\\Bad.exe -enc SQBFAFgAIAAoAE4AZQB3AC0ATwBiAGoA from evil[.]example[.]com, hxxps://x.test/a and 10.0.0.1; a.b.c.test"
    pieces = [source[i : i + n] for i in range(0, len(source) - 5, 7) for n in (3, 12, 35, 60)]
    values = [*pieces, *(p.upper() for p in pieces), "evil.example.com", "https://x.test/a", "10[.]0[.]0[.]1", "a[.]b.c[.]test", "", "  ", "missing.exe", "zz" + source[4:50] + "zz", "x" * 40, ". . . . . . . . . . . . . . . . . . ."]
    for field in ("command_lines", "scripts", "registry_keys", "domains"):
        assert validate.supported(source, [(field, v) for v in values]) == [held(source, field, v) for v in values]
    assert validate.supported(source, []) == [] and validate.supported(source, [("urls", "")]) == [True]
