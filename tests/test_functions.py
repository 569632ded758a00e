"""Table-driven tests of column expressions."""

import datetime as dt
import unicodedata
from urllib.parse import parse_qsl, urlencode, urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palisade.functions import dates, indicators, responses, text, urls


def pairs(table):
    return [a for a, _ in table], [b for _, b in table]


def test_normalize_url(column):
    given_, want = pairs([
        ("https://Example.test/Resources/blog-uk/post/?utm_source=x&a=#top", "https://example.test/Resources/blog/post?a="),
        ("HTTP://example.test", "http://example.test/"),
        ("https://example.test/de/blog/x//", "https://example.test/blog/x"),
        ("https://example.test/a;v=1?q=a b&x=b=c&foo", "https://example.test/a?q=a+b&x=b%3Dc&foo="),
        ("https://example.test/a?q=%7E*%C3%A9", "https://example.test/a?q=~%2A%C3%A9"),
        (" https://example.test/blog-en-us/p ", "https://example.test/blog/p"),
        ("https://example.test/?UTM_x=1", "https://example.test/"),
    ])
    assert column(urls.normalize_url, given_) == want
    assert column(urls.normalize_url, want) == want
    for q in ("q=a b&x=b=c&y=~*", "a=&b=%20"):
        (got,) = column(urls.normalize_url, [f"https://e.test/?{q}"])
        assert got == "https://e.test/?" + urlencode(parse_qsl(q, keep_blank_values=True))


def test_collapse_segments(column):
    given_, want = pairs([("https://e.test/a/a/b", "https://e.test/a/b"), ("https://e.test/a/b", None), ("https://e.test/a/a/a?x=1", "https://e.test/a?x=1"), ("https://e.test/ab/b/", None)])
    assert column(urls.collapse_segments, given_) == want


@pytest.mark.parametrize("base", ["https://e.test/a/b.html?q=1#f", "http://e.test"])
def test_resolve(column, base):
    hrefs = ["c.html", "/x/y", "//cdn.test/z", "https://o.test/", "?p=2", "#top", "../up", "./here", "d/../e?x", "mailto:a@e.test", ""]
    assert column(lambda h: urls.resolve(F.lit(base), h), hrefs) == [urljoin(base, h) for h in hrefs]


def test_links(column):
    given_, want = pairs([("https://e.test/blog/2024/05/some-post", 0), ("https://e.test/research/x", 1), ("https://e.test/a/one-two-three-four", 2), ("https://e.test/product", 3)])
    assert column(urls.link_priority, given_) == want
    given_, want = pairs([
        (("https://e.test/pricing/", ""), False), (("https://e.test/x", "our new announcement"), False), (("https://e.test/malware/x", ""), True),
        (("https://e.test/x", "New stealer"), True), (("https://blog.e.test/2024/05/x", ""), True), (("https://e.test/tech_blog/abcdef_x", ""), True),
        (("https://e.test/blog/index", ""), False), (("https://e.test/one-two-thre-four", ""), True), (("https://e.test/about-us", ""), False),
    ])
    assert column(lambda v: urls.probable_link(v[0], v[1]), [list(x) for x in given_], "array<string>") == want
    assert column(urls.bad_path, ["https://e.test/about-x", "https://e.test/?paged=2", "https://e.test/p"]) == ["/about", r"\?paged=\d+", None]
    assert column(urls.is_feed_url, ["https://feeds.e.test/x", "https://e.test/x"]) == [True, False]
    assert column(urls.source_label, ["https://www.foo.com/x", "https://a.com.test/"]) == ["foo", "a.test"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_clean_text_is_ascii_folding(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(text.clean_text(F.col("t")).alias("c"))
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if 31 < ord(c) < 127) for t in texts]
    assert sorted(r.c for r in df.collect()) == sorted(want)


@pytest.mark.parametrize("n", [0, 1, 16_500, 16_501, 18_000, 18_001, 40_000])
def test_chunks_cover_the_text(column, n):
    t = "".join(chr(97 + i % 26) for i in range(n))
    (got,) = column(text.chunks, [t])
    assert got == [t[i : i + 18_000] for i in range(0, n, 16_500)]
    assert "".join(c[:16_500] for c in got)[: n - 1] == t[: n - 1]


def test_gate(column):
    given_, want = pairs([("", 0), ("Malware attack", 2), ("see CVE-2024-12345", 3), ("T1059 only", 0), ("host evil.example.test", 2), ("a chapter", 1)])
    assert column(text.gate_score, given_) == want
    assert column(lambda t: text.gate_score(t, True), ["uses T1059"]) == [2]


def test_readable(column):
    given_, want = pairs([("", False), ("short", False), ("C:\\Windows\\System32\\cmd.exe /c whoami", True), ("a b c d e f g h i j k l m n", False), ("This is plausible prose from an image", True), ("1234567890 1234567890 12345", False), (None, False)])
    assert column(text.readable, given_) == want


def test_titles(column):
    given_, want = pairs([("A new stealer", False), ("e current user session", True), ("The actor used it. Then it left.", True), ("x" * 201, True), (None, False), ("The loader", False)])
    assert column(text.corrupt_title, given_) == want


def test_hashes(column):
    md5, sha1, sha256 = "a1" * 16, "b2" * 20, "c3" * 32
    given_, want = pairs([
        ([f"MD5:{md5}", f"SHA256: {sha256}"], [md5, sha256]), ([f"MD5|{md5.upper()}", md5], [md5]), ([f"MD5{md5}"], [md5]), ([f"SHA-1:{sha1}"], [sha1]),
        (["abc", None, ""], []), ([f"file {sha1} and {md5}"], [sha1, md5]), ([], []), (["d" * 33], []),
    ])
    assert column(indicators.normalize_hashes, given_, "array<string>") == want


def test_reserved_ip(column):
    given_, want = pairs([
        ("10.1.2.3", True), ("172.16.0.1", True), ("172.32.0.1", False), ("192[.]168[.]1[.]1", True), ("127.0.0.1:80", True), ("169.254.1.1", True), ("224.0.0.1", True),
        ("240.0.0.1", False), ("255.1.1.1", True), ("0.0.0.0", True), ("300.1.1.1", True), ("203.0.113.9", False), ("2001:db8::1", False), ("203.0.113.0/24", False), ("", False),
    ])
    assert column(indicators.reserved_ip, given_) == want


def test_placeholders(column):
    given_, want = pairs([
        (None, True), ("  ", True), ("[]", True), ("<author name>", True), ("N/A", True), ("na", True), ("unknown", True), ("unknown actor", False), ("Placeholder text", True), ("example domain", True),
        ("CVE-YYYY-1", True), ("x deadbeefdeadbeefdeadbeefdeadbeef", True), ("C:\\\\Users\\\\Public\\\\update.exe", True), ("Real Name", False), ("nullable", False),
    ])
    assert column(indicators.placeholder, given_) == want


def test_lists(column):
    given_, want = pairs([("- Point Wild", ["Point Wild"]), ("- foo\n- bar", ["foo", "bar"]), ("[]", []), ("[a, 'b', \"c\"]", ["a", "b", "c"]), ("Single Value", ["Single Value"]), (None, []), ("", [])])
    assert column(indicators.as_list, given_) == want
    assert column(indicators.distinct_ignoring_case, [["A.test", " a.test ", None, "", "b"]], "array<string>") == [["A.test", "b"]]


def test_in_source(column):
    src = F.lit("Seen at evil[.]example[.]net and hxxps://a.test/x, runs powershell -enc AAAABBBBCCCCDDDDEEEE")
    given_, want = pairs([("evil.example.net", True), ("https://a.test/x", True), ("other.test", False), ("", True), ("a[.]test", True)])
    assert column(lambda v: indicators.in_source(src, v), given_) == want
    given_, want = pairs([("cmd /c powershell -enc AAAABBBBCCCCDDDDEEEE now", True), ("nothing of this kind is in the text at all", False), ("short", False), ("-----------------------------", False)])
    assert column(lambda v: indicators.in_source_windows(src, v), given_) == want


def test_misc(column):
    assert column(indicators.strip_markdown_link, ["[a.test](https://a.test)", "plain"]) == ["a.test", "plain"]
    assert column(indicators.malware_slug, [["Ice ID!"], [], ["***"]], "array<string>") == ["ice-id", "unknown", "unknown"]
    body = '{"archived_snapshots": {"closest": {"available": true, "url": "http://web.archive.org/web/2024/http://a.test"}}}'
    assert column(responses.snapshot_url, [body, "{}"]) == ["http://web.archive.org/web/2024id_/http://a.test", None]


def test_dates(column):
    d = dt.date(2024, 5, 9)
    given_, want = pairs([("2024-05-09", d), ("2024-05-09T10:00:00Z", d), ("9 May 2024", d), ("May 9, 2024", d), ("Thu, 09 May 2024 10:00:00 +0000", d), ("soon", None), (None, None)])
    assert column(dates.any_date, given_) == want
    assert column(dates.url_date, ["https://e.test/2024/05/9/x", "https://e.test/2024-13-40", "https://e.test/"]) == [d, None, None]
    assert column(lambda t: dates.text_date(t, F.lit(2024)), ["on 9 May 2024", "in 1990-01-01", ""]) == [d, None, None]
    assert column(lambda v: dates.long_form(v.cast("date")), ["2024-05-09"]) == ["May 09, 2024"]
