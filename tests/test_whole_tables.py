"""Registered queries over whole tables and whole texts."""

import datetime as dt

from palisade.plans import catalog


def test_feed_entries_of_every_event(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=7 * i, milliseconds=i)) for i in range(100)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.event_id, r.link, r.published) for r in catalog.QUERIES["feed_entries"](spark, str(tmp_path)).collect()}
    assert got == {(i, f"https://feed.example.test/{i}", t.replace(microsecond=0)) for i, t in rows}


def test_dedupe_ci_of_whole_texts(spark, tmp_path):
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    long = " ".join(word(i % 3000).upper() if i % 2 else word(i % 3000) for i in range(7001))
    texts = [long, "", None, "- ", "A b a B c", "x" * 500 + " Y y"]
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.words for r in catalog.QUERIES["dedupe_ci"](spark, str(tmp_path)).collect()}
    want = {}
    for w in long.split():
        want.setdefault(w.lower(), w)
    assert got == {0: ",".join(want.values()), 4: "A,b,c", 5: "x" * 500 + ",Y"}
