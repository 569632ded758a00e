"""Records, repair, pages, fetching, services, sinks and streams, on small hand-made inputs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from palisade import config, providers
from palisade.operators import fetch, html, images, links, merge, metrics, records, throttle, validate
from palisade.operators.yaml_repair import extract
from palisade.plans import articles
from palisade.sources import corpus, feeds, lists
from palisade.sources.processed import ProcessedSet
from palisade.streaming import ingest

DOC = "title: Foo\nttps:\n  processes: [cmd.exe]\n"


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        (f"Here it is:\n```yaml\n{DOC}```\nbye", {"title": "Foo", "ttps": {"processes": ["cmd.exe"]}}),
        (DOC, {"title": "Foo", "ttps": {"processes": ["cmd.exe"]}}),
        ("Sure: here you go\nand more - [text\n" + DOC, {"title": "Foo", "ttps": {"processes": ["cmd.exe"]}}),
        (DOC + "cves:\n- CVE-2024-1\n- \"CVE-20", {"title": "Foo", "ttps": {"processes": ["cmd.exe"]}, "cves": ["CVE-2024-1"]}),
        ("title: Foo\nttps:\n\tprocesses: [a]\n", {"title": "Foo", "ttps": {"processes": ["a"]}}),
        ("title: Foo: the bar\n", {"title": "Foo: the bar"}),
        ("ttps:\n  powershell:\n  - [Convert]::FromBase64String('x') | iex: {\n", {"ttps": {"powershell": ["[Convert]::FromBase64String('x') | iex: {"]}}),
        ("- title: Foo\n- cves: [a]\n- cves: [a, b]\n- title: Bar\n", {"title": "Foo", "cves": ["a", "b"]}),
        ("", None), ("nothing here", None), (None, None),
    ],
)
def test_repair(answer, want):
    assert extract(answer) == want


def _records(spark, docs):
    return spark.createDataFrame([(f"u{i}", 0, json.dumps(d)) for i, d in enumerate(docs)], "url string, chunk_idx int, document string")


def test_normalize(spark):
    old = {
        "title": "e fragment of text", "attribution": ["APT", "X"], "CVEs": "- CVE-2024-1\n- N/A", "malware_families": "['icedid']", "author": "Ann",
        "TTPs": {"commandline": ["whoami", None], "processes": "cmd.exe"}, "IOCs": {"Hashes": ["MD5:" + "A1" * 16], "ips": ["10.0.0.1", "203.0.113.9"], "domains": ["[a.test](https://a.test)", "A.TEST"]}, "zzz": [1],
    }
    flat = {"title": "T", "iocs": ["evil[.]test", "b2" * 20, "203.0.113.7", "hxxp://x.test/a"], "persistence": ["key"]}
    a, b = records.normalize(_records(spark, [old, flat])).orderBy("url").collect()
    assert (a.title, a.attribution, a.cves, a.malware_families, a.authors) == ("", "APT X", ["CVE-2024-1"], ["icedid"], ["Ann"])
    assert a.ttps.command_lines == ["whoami"] and a.ttps.processes == ["cmd.exe"] and a.ttps.scripts == []
    assert a.iocs.hashes == ["a1" * 16] and a.iocs.ip_addresses == ["203.0.113.9"] and a.iocs.domains == ["a.test"]
    assert a.extras.toPython() == {"zzz": [1]}
    assert b.iocs.asDict() == {"hashes": ["b2" * 20], "ip_addresses": ["203.0.113.7"], "domains": ["evil[.]test"], "urls": ["hxxp://x.test/a"]}
    assert b.ttps.persistence == ["key"]


def test_names_of_mixed_models_are_united(spark):
    """Lists under old and new names, in place, in either container and misplaced; what isn't a list follows the first name."""
    docs = [
        {"cves": ["A", "A"], "CVEs": ["B", "A", "B"], "ttps": {"command_lines": ["x"], "commandline": ["y", "x"], "command_line": ["z"]}, "TTPs": {"command_lines": ["lost"], "processes": ["p"]}},
        {"ttps": {"scripts": "one", "scripting_engine": ["two"]}, "iocs": {"domains": ["a.test"]}, "IOCs": {"domains": ["b.test"], "ips": ["203.0.113.5"]}, "urls": ["http://c.test/"], "domains": ["not.used"]},
        {"commandline": ["top"], "registry_keys": "- a\n- b", "ttps": None, "hashes": ["[x](http://y.test) MD5:" + "b1" * 16], "image_loads": ["[l.dll](https://z.test/l)  "]},
        {"authors": None, "author": "Ann", "cves": [None, " ", "C"], "iocs": "10.1.1.1", "extra": {"n": [1, None]}},
        {"ttps": ["not", "a", "map"], "title": ["Two", "parts"], "description": 7, "zero": 0},
    ]
    rows = [json.dumps(d) for d in docs] + ["not json", "[1]", "{}", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, document string")
    got = records.normalize(df.withColumns({c: F.lit("clash") for c in ("x", "v", "k")})).orderBy("i").collect()
    assert got[0].cves == ["A", "A", "B"] and got[0].ttps.command_lines == ["x", "y", "z"] and got[0].ttps.processes == ["p"]
    assert got[1].ttps.scripts == ["one"] and got[1].iocs.domains == ["a.test"] and got[1].iocs.ip_addresses == ["203.0.113.5"] and got[1].iocs.urls == ["http://c.test/"]
    assert got[2].ttps.command_lines == ["top"] and got[2].ttps.registry_keys == ["a", "b"] and got[2].iocs.hashes == ["b1" * 16] and got[2].ttps.image_loads == ["l.dll"]
    assert got[3].authors == ["Ann"] and got[3].cves == ["C"] and got[3].extras.toPython() == {"extra": {"n": [1, None]}} and got[3].iocs.domains == []
    assert got[4].title == "Two parts" and got[4].description == "7" and got[4].ttps.processes == [] and got[4].extras.toPython() == {"zero": 0}
    assert all(r.title == "" and r.cves == [] and r.iocs.urls == [] for r in got[5:]) and got[7].extras.toPython() == {} and got[8].x == "clash"


def test_plan_of_normalize_is_small(spark):
    import time

    df = _records(spark, [{"title": "T"}])
    records.normalize(df)
    began = time.perf_counter()
    for _ in range(5):
        out = records.normalize(df)
    assert (time.perf_counter() - began) / 5 < 1.0  # 0.2 s where nothing else runs
    assert len(out._jdf.queryExecution().toString()) < 400_000


def test_normalize_is_idempotent(spark):
    doc = {"title": "T", "ttps": {"processes": ["a", "a"]}, "iocs": {"domains": ["x.test"]}, "cves": ["CVE-2024-1"]}
    once = records.normalize(_records(spark, [doc]))
    cols = [c for c in once.columns if c not in ("url", "chunk_idx", "extras")]
    twice = records.normalize(once.select("url", "chunk_idx", F.to_json(F.struct(*cols)).alias("document")))
    assert once.select(cols).collect() == twice.select(cols).collect()


def test_fold_and_usable(spark):
    rows = [("a", 0, "", "short", ["x"]), ("a", 1, "T", "a longer one", ["y", "x"]), ("a", 2, "U", "z" * 1001, ["x"]), ("b", 0, None, "w" * 1001, None), ("b", 1, None, "v" * 900, [])]
    df = spark.createDataFrame(rows, "k string, i int, t string, d string, l array<string>")
    got = {r.k: r for r in merge.fold_chunks(df, "k", "i", ("t",), ("d",), ("l",)).collect()}
    assert (got["a"].t, got["a"].d, got["a"].l, got["a"].n_chunks) == ("T", "a longer one", ["x", "y"], 3)
    assert (got["b"].t, got["b"].d, got["b"].l) == ("", "w" * 1001, [])
    rows = [("a", 0, None), ("a", 1, "{}"), ("b", 0, "{}"), ("b", 1, None), ("c", 0, None)]
    df = spark.createDataFrame(rows, "k string, i int, d string")
    assert [(r.k, r.i) for r in merge.usable(df, "k", "i", "d").collect()] == [("b", 0)]


def test_cross_validate(spark):
    doc = {"ttps": {"registry_keys": ["HKLM\\Real", "HKLM\\Made"], "scripts": ["a.ps1", "gone.ps1"], "processes": ["made.exe"]}, "iocs": {"domains": ["real.test", "made.test"]}}
    r = records.normalize(_records(spark, [doc])).withColumn("text", F.lit("uses hklm\\real and a.ps1 at real[.]test"))
    got = validate.cross_validate(r, "text").first()
    assert (got.ttps.registry_keys, got.ttps.scripts, got.ttps.processes, got.iocs.domains, got.n_dropped) == (["HKLM\\Real"], ["a.ps1"], ["made.exe"], ["real.test"], 3)
    assert validate.cross_validate(r.withColumn("text", F.lit("")), "text").first().n_dropped == 0


PAGE = """<html><head><title>T &amp; U</title><link rel="alternate" type="application/rss+xml" href="/feed"><meta property="article:published_time" content="2024-05-09T01:02:03Z"></head>
<body><nav><a href="/n">n</a><img src="/logo.png"></nav><article><h1>Head</h1><p>One <b>two</p><pre><code>rm -rf</code></pre>
<table><tr><th>a</th><td>b</td></tr></table><img data-src="i.png"><img src="i.png"><div class="related-posts">no</div><script>var t="</p>";</script></article></body></html>"""


def test_page_parts(spark):
    p = html.parts(PAGE)
    assert p["title"] == "T & U" and p["feeds"] == ["/feed"] and p["meta_date"].startswith("2024") and p["images"] == ["i.png"]
    assert "One" in p["body"] and "no" not in p["body"].split("\n") and "var" not in p["body"] and p["code"] == "rm -rf\nrm -rf" and p["tables"] == "a\tb"
    assert html.parts(None)["body"] == "" and html.parts("<main>m</main>")["body"] == "m" and html.parts('<div class="post-body">c</div>x')["body"] == "c"
    df = spark.createDataFrame([("https://e.test/a/", PAGE)], "url string, body string").select("url", html.page_parts("body").alias("parts"))
    assert [r.image_url for r in html.article_images(df).collect()] == ["https://e.test/a/i.png"]
    assert "=== TABLES ===\n\na\tb" in df.select(html.rich_text(F.col("parts")).alias("t")).first().t


def test_page_links(spark):
    page = '<a href="/x/">1</a><a href="https://other.test/y">2</a><a href="/">3</a><a class="c" href="/x">4</a><a href="b/b/c">5</a>'
    df = spark.createDataFrame([("https://e.test/", page)], "url string, html string")
    assert [r.link for r in links.page_links(df).orderBy("link").collect()] == ["https://e.test/b/c", "https://e.test/x"]


def test_candidates_prefer_feeds(spark):
    today = F.lit("2024-05-10").cast("date")
    entries = spark.createDataFrame([("s1", "https://s1.test/new", dt.datetime(2024, 5, 9)), ("s1", "https://s1.test/old", dt.datetime(2024, 4, 1)), ("s1", "https://s1.test/undated", None), ("s3", "https://s3.test/old", dt.datetime(2024, 1, 1))], "source string, link string, published timestamp")
    index = spark.createDataFrame([("s2", f"https://s2.test/blog/p{i:02d}") for i in range(20)] + [("s1", "https://s1.test/x"), ("s3", "https://s3.test/y"), ("s2", "https://s2.test/about")], "source string, link string")
    done = spark.createDataFrame([("https://s2.test/blog/p00",)], "url_norm string")
    got = links.candidates(entries, index, done, done, today).collect()
    assert {r.url for r in got if r.source == "s1"} == {"https://s1.test/new", "https://s1.test/undated"}
    assert [r for r in got if r.source == "s3"] == [] and len([r for r in got if r.source == "s2"]) == 12


def test_fetch_outcomes_and_recovery(spark):
    web = {"https://a.test/x/x": (404, "text/html", ""), "https://a.test/x": (200, "text/html", "<p>found</p>"), "https://a.test/gone": (404, "text/html", "no"), "https://a.test/d.pdf": (200, "text/html", "x"), "https://a.test/bot": (200, "text/html", "Just a moment")}
    web["https://archive.org/wayback/available?url=https://a.test/gone"] = (200, "application/json", '{"archived_snapshots": {"closest": {"available": true, "url": "https://web.archive.org/web/2024/https://a.test/gone"}}}')
    web["https://web.archive.org/web/2024id_/https://a.test/gone"] = (200, "text/html", "old copy")

    def call(url):
        return web[url]

    links_ = spark.createDataFrame([(u,) for u in list(web)[:1] + list(web)[2:5] + ["https://a.test/none"]], "url string")
    got = {r.url: (r.outcome, r.body) for r in fetch.with_recovery(fetch.fetch(links_, call, 0.0), call, 0.0).collect()}
    assert got == {"https://a.test/x/x": ("ok", "<p>found</p>"), "https://a.test/gone": ("ok", "old copy"), "https://a.test/d.pdf": ("pdf", ""), "https://a.test/bot": ("challenge", ""), "https://a.test/none": ("failed", "")}


def test_waits(spark):
    rows = [("d", 0.0), ("d", 0.5), ("d", 3.0), ("e", 1.0)]
    df = spark.createDataFrame(rows, "d string, s double").withColumn("at", F.timestamp_seconds("s"))
    assert [(r.d, r.wait) for r in throttle.waits(df, "d", "at", 2.0).orderBy("d", "s").collect()] == [("d", 0.0), ("d", 1.5), ("d", 0.0), ("e", 0.0)]


def test_waits_of_all_requests_in_ranges(spark):
    seconds = [0.0, 0.4, 0.4, 3.0, 3.1, 9.0, 9.5, 20.0, 21.0, 21.5, 30.0]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seconds)], "i int, s double").withColumn("at", F.timestamp_seconds("s"))
    got = {r.i: round(r.wait, 3) for r in throttle.waits(df, None, "at", 2.0, tie="i", parts=4).collect()}
    assert got == {i: round(max(0.0, 2.0 - (s - seconds[i - 1])), 3) if i else 0.0 for i, s in enumerate(seconds)}


REPLIES = {
    "lmstudio": '{"choices": [{"message": {"content": "hi"}}]}', "openai": '{"choices": [{"message": {"content": "hi"}}]}', "ollama": '{"message": {"content": "hi"}}',
    "claude": '{"content": [{"text": "hi"}]}', "gemini": '{"candidates": [{"content": {"parts": [{"text": "hi"}]}}]}',
}


@pytest.mark.parametrize("name", REPLIES)
def test_providers(name):
    key = "k" if providers.SERVICES[name].key_variable else None
    seen = []
    p = providers.create(name, api_key=key, transport=lambda *a: seen.append(a) or (200, REPLIES[name]))
    assert p.generate("sys", "user") == "hi" and "sys" in json.dumps(seen[0][2]) and "user" in json.dumps(seen[0][2])
    p = providers.create(name, api_key=key, transport=lambda *a: (500, '{"error": {"message": "no"}}'))
    with pytest.raises(RuntimeError, match="no"):
        p.generate("s", "u")
    with pytest.raises(RuntimeError, match="unexpected"):
        p.reply(200, "{}")
    if key:
        with pytest.raises(ValueError, match="fixed endpoint"):
            providers.create(name, api_key=key, endpoint="http://x")


def test_provider_errors(monkeypatch):
    with pytest.raises(ValueError, match="unknown provider"):
        providers.create("other")
    monkeypatch.delenv("OPENAI_API_KEY", raising=False)
    with pytest.raises(ValueError, match="API key"):
        providers.create("openai")
    with pytest.raises(ValueError, match="strings"):
        providers.create("ollama").generate("s", None)


def test_config():
    c = config.from_environment({"REQUEST_DELAY": "1.5", "VERBOSE": "true"}, ["--ollama", "--model", "m"])
    assert (c.request_delay, c.verbose, c.provider, c.model, c.max_articles) == (1.5, True, "ollama", "m", 12)


RSS = "<rss><channel><title>c</title><item><title>a</title><link>https://e.test/a</link><pubDate>Thu, 09 May 2024 10:00:00 +0000</pubDate></item><item><link>https://e.test/b</link></item></channel></rss>"
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link rel="alternate" href="https://e.test/c"/><published>2024-05-09T10:00:00Z</published></entry></feed>'


def test_feed_entries(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("n", "<rss></rss>")], "source string, xml string")
    got = sorted((r.source, r.link, r.published) for r in feeds.feed_entries(df).collect() if r.link != "https://e.test/b")
    at = dt.datetime(2024, 5, 9, 10)
    assert got == [("a", "https://e.test/c", at), ("r", "https://e.test/a", at)]


def test_lists_and_processed(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("https://E.test/\n\nhttps://e.test/blog/x\n")
    assert [r.url_norm for r in lists.source_list(spark, str(tmp_path / "urls.txt")).orderBy("pos").collect()] == ["https://e.test/", "https://e.test/blog/x"]
    assert lists.start_urls(spark, str(tmp_path / "none")).count() == 0
    starts = lists.start_urls(spark, str(tmp_path / "urls.txt"))
    done = spark.createDataFrame([("https://e.test/p", "ok"), ("https://e.test/p/", "ok"), ("https://e.test/blog/x", "ok"), ("https://e.test/about", "ok"), ("https://e.test/", "ok"), ("https://e.test/f", "failed")], "url string, outcome string")
    for _ in range(2):
        lists.append_processed(done, str(tmp_path / "done"), starts)
    assert [r.url_norm for r in lists.processed_urls(spark, str(tmp_path / "done")).collect()] == ["https://e.test/p"]


def test_stream(spark, tmp_path):
    spark.dataSource.register(feeds.FeedFolder)
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "one.xml").write_text(RSS)
    starts = spark.createDataFrame([], "url_norm string")
    today = F.lit("2024-05-10").cast("date")

    def poll():
        stream = spark.readStream.format("feed_folder").option("path", str(folder)).load()
        q = ingest.ingest(ingest.fresh_entries(stream, today), str(tmp_path / "done"), starts, str(tmp_path / "state"), available_now=False)
        q.processAllAvailable()
        q.stop()
        return sorted(r.url_norm for r in ProcessedSet(spark, str(tmp_path / "done")).urls().collect())

    assert poll() == ["https://e.test/a", "https://e.test/b"]
    (folder / "two.xml").write_text(ATOM.replace("</feed>", '<entry><link href="https://e.test/a"/></entry></feed>'))
    assert poll() == ["https://e.test/a", "https://e.test/b", "https://e.test/c"]


def test_articles_end_to_end(spark):
    body = "<article><p>" + "The malware campaign used evil[.]example[.]net. " * 5 + "</p></article>"
    pages = spark.createDataFrame([("https://e.test/2024/05/09/x", body), ("https://e.test/y", "<article>cats</article>")], "url string, body string")
    arts = articles.articles(pages, None, F.lit("2024-05-10").cast("date")).cache()
    assert {r.url: r.report for r in arts.collect()} == {"https://e.test/2024/05/09/x": True, "https://e.test/y": False}
    chunked = articles.article_chunks(arts)
    answers = chunked.withColumn("raw", F.lit("```yaml\ntitle: X\niocs:\n  domains: [evil.example.net, made.example.net]\n```"))
    docs, dead = articles.extracted(answers)
    (r,) = articles.article_records(docs, arts, F.lit("2024-05-10").cast("date")).collect()
    assert (r.reference, r.iocs.domains, r.n_dropped, r.date_of_publication) == ("https://e.test/2024/05/09/x", ["evil.example.net"], 1, dt.date(2024, 5, 9))
    assert dead.count() == 0


def test_sinks(spark, tmp_path):
    doc = {"title": "T", "malware_families": ["Ice ID"], "iocs": {"domains": ["a.test"]}, "ttps": {"process_relations": ["a -> b"], "network_connections": ["a -> b.test:443"]}}
    r = records.normalize(_records(spark, [doc])).withColumns({"reference": F.lit("https://www.e.com/x"), "date_of_publication": F.lit("2024-05-09").cast("date"), "file_creation_date": F.lit("2024-05-10").cast("date")})
    corpus.write_records(r, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("year = 2024 and month = '05'").count() == 1
    (f,) = corpus.write_yaml(r, f"file://{tmp_path}/y").collect()
    assert f.path.startswith("2024/05/20240510-000000-e-ice-id-")
    back = corpus.corpus(corpus.read_files(spark, str(tmp_path / "y"))).first()
    assert back.title == "T" and back.iocs.domains == ["a.test"] and back.date_of_publication == dt.date(2024, 5, 9)
    assert [(e.src, e.dst, e.port) for e in records.edges(r, "reference").orderBy("kind").collect()] == [("a", "b.test", 443), ("a", "b", None)]
    assert [(i.kind, i.value_fanged, i.family) for i in records.indicators(r).collect()] == [("domains", "a.test", "Ice ID")]


def test_unknown_keys_are_merged(spark):
    docs = [
        {"title": "T", "severity": "", "tags": ["a"], "actor": {"name": "x", "seen": ["1"]}},
        {"severity": "high", "tags": ["b", "a", "b"], "actor": {"name": "y", "seen": ["2", "1"], "empty": ""}},
        {"severity": "low", "note": "n", "tags": [], "actor": "z"},
    ]
    rows = spark.createDataFrame([("u", i, json.dumps(d)) for i, d in enumerate(docs)] + [("v", 0, json.dumps({"title": "W"}))], "url string, chunk_idx int, document string")
    got = {r.url: r for r in records.merge_records(records.normalize(rows), "url", "chunk_idx").collect()}
    assert got["u"].extras.toPython() == {"severity": "high", "tags": ["a", "b"], "actor": {"name": "y", "seen": ["1", "2"]}, "note": "n"}
    assert got["v"].extras.toPython() == {} and got["u"].title == "T"


def test_main_text_where_nothing_tells_it():
    long = "Words of the report. " * 30
    page = f"<body><div id='a'><ul><li><a href='/1'>{long}</a></li></ul></div><div id='b'><h1>H</h1><p>{long}</p><p>{long}</p></div><div id='c'><p>small print</p></div></body>"
    assert html.parts(page)["body"].count("Words") == 60 and "small" not in html.parts(page)["body"] and "H" in html.parts(page)["body"].split("\n")
    assert html.parts("<body><p>too short</p><b>x</b></body>")["body"] == "too short\nx"


def test_feeds_of_a_source(spark):
    page = spark.createDataFrame([("https://e.test/", PAGE), ("https://f.test/", "<p>none</p>")], "source string, body string").select("source", html.page_parts("body").alias("parts"))
    head = lambda url: (200, "application/rss+xml", "") if url == "https://f.test/rss" or url == "https://e.test/feed" else (404, "", "")
    found = fetch.source_feeds(page, head)
    assert sorted((r.source, r.feed) for r in found.collect()) == [("https://e.test/", "https://e.test/feed"), ("https://f.test/", "https://f.test/rss")]
    assert feeds.choose_feed(found).count() == 2


def test_images_are_read_once(spark):
    import numpy as np

    def fetch_image(url):
        if "gone" in url:
            raise OSError
        return 200, "image/svg+xml" if "svg" in url else "image/png; charset=x", url.encode()

    def decode(content):
        if b"odd" in content:
            raise ValueError
        return np.zeros((40, 50, 3), np.uint8) if b"small" in content else np.full((400, 700, 3), 200, np.uint8)

    names = ["a", "a", "small", "gone", "odd", "svg", "mute"]
    df = spark.createDataFrame([(f"https://i.test/{n}",) for n in names], "image_url string")
    said = lambda x: "" if (x == 0).all() else "The malware beacon reaches evil.example.net every hour"
    read = images.read_images(df, fetch_image, lambda x: said(x), decode)
    got = {r.image_url.rpartition("/")[2]: (r.skipped, r.text[:11]) for r in read.collect()}
    assert got == {"a": (None, "The malware"), "small": ("too small (50x40)", ""), "gone": ("failed", ""), "odd": ("undecodable", ""), "svg": ("content type", ""), "mute": (None, "The malware")}
    assert images.image_summary(read).first().asDict() == {"n_images": 6, "n_with_text": 2}
    flat = images.prepare(np.full((5, 6, 3), 90, np.uint8))
    assert flat.shape == (5, 6) and (flat == 90).all()
    edge = images.prepare(np.repeat([[60, 60, 60, 140, 140, 140]], 6, axis=0).astype(np.uint8))
    assert edge[2, 2] < edge[2, 1] < edge[2, 4] < edge[2, 3]  # more contrast, and more at the edge


def test_images_are_remembered_over_runs(spark, tmp_path):
    """What is fetched and recognised in three runs: new images, failed ones again, no bytes twice."""
    import numpy as np

    log = tmp_path / "log"
    log.mkdir()

    def note(kind, name):
        (log / f"{kind}-{name}-{len(list(log.iterdir()))}-{np.random.default_rng().integers(1 << 60)}").touch()

    def fetch_image(url):
        name = url.rpartition("/")[2]
        note("fetch", name)
        if name == "gone" and not (tmp_path / "back").exists():
            raise OSError
        return 200, "image/png", b"same" if name in ("a", "b", "late") else name.encode()

    def recognise(pixels):
        note("read", int(pixels[0, 0]))
        return "The malware beacon reaches evil.example.net every hour"

    decode = lambda content: np.full((50, 60) if content == b"small" else (400, 700), content[0], np.uint8)
    run = lambda *names: {r.image_url.rpartition("/")[2]: (r.skipped, r.text[:3]) for r in images.read_remembered(spark.createDataFrame([(n and f"https://i.test/{n}",) for n in names], "image_url string"), str(tmp_path / "memo"), fetch_image, recognise, decode, lambda x: x).collect()}
    calls = lambda kind: sorted(p.name.split("-")[1] for p in log.iterdir() if p.name.startswith(kind))
    want = {"a": (None, "The"), "b": (None, "The"), "small": ("too small (60x50)", ""), "gone": ("failed", "")}
    assert run("a", "b", "a", "small", "gone", None) == want
    assert calls("fetch") == ["a", "b", "gone", "small"] and calls("read") == [str(ord("s"))]
    (tmp_path / "back").touch()
    assert run("a", "b", "small", "gone", "late") == want | {"gone": (None, "The"), "late": (None, "The")}
    assert calls("fetch") == ["a", "b", "gone", "gone", "late", "small"] and calls("read") == sorted(map(str, (ord("s"), ord("g"))))
    assert run("gone", "a") == {"gone": (None, "The"), "a": (None, "The")} and len(calls("fetch")) == 6


def test_counters_of_a_plan(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, t string")
    out, seen = metrics.observed(df, "read", large=F.col("n") > 1, named=F.col("t") == "a")
    out, kept = metrics.observed(out.where("n > 1"), "kept")
    assert out.count() == 2
    assert metrics.log_rows({"read": seen, "kept": kept}) == [("read", "n_rows", 3), ("read", "large", 2), ("read", "named", 1), ("kept", "n_rows", 2)]


def test_a_pace_over_tasks():
    """Calls of three tasks, one of which starts late, are never closer together than the interval."""
    calls = []
    for task, begin in ((0, 0.0), (1, 0.0), (2, 31.7)):
        now = [begin]
        pace = throttle.Pace(2.0, task, 3, 0.0, clock=lambda now=now: now[0], sleep=lambda s, now=now: now.__setitem__(0, now[0] + s))
        for _ in range(10):
            pace.wait()
            calls.append(now[0])
            now[0] += 0.3
    calls.sort()
    assert all(b - a >= 2.0 - 1e-9 for a, b in zip(calls, calls[1:], strict=False)) and calls[0] == 0.0


def test_estimates(column):
    from palisade.functions.text import decodable, logged_tokens

    assert column(logged_tokens, ["x" * 34, "", None]) == [10, 0, None]
    assert column(decodable, ["image/PNG; q=1", "", None, "image/svg+xml", "text/html"]) == [True, True, True, False, False]


def test_passages_in_documents(spark):
    docs = spark.createDataFrame([(1, "One TWO three four five"), (2, "xone two three four fivex and a b"), (3, "two three"), (4, None), (5, "one two  three four five")], "doc_id int, text string")
    items = spark.createDataFrame([("p", "one two three four five"), ("q", " Two three "), ("r", "a b"), ("s", None), ("t", "no such words at all")], "item_id string, text string")
    got = sorted((r.item_id, r.doc_id) for r in validate.occurrences(docs, items).collect())
    assert got == [("p", 1), ("p", 2), ("q", 1), ("q", 2), ("q", 3), ("r", 2)]
