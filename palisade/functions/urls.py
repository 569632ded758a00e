"""URL expressions; all run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import constants as C


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def contains_any(text: Column, words: list[str]) -> Column:
    return any_of([F.contains(text, F.lit(w)) for w in words])


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def path(url: Column) -> Column:
    """The path without ;parameters of its last segment."""
    whole = F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(whole, ";[^/]*$", "")


def query(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^[^?#]*\?([^#]*)", 1)


def _form(text: Column) -> Column:
    """Percent-encoding as in forms: decoded, then encoded with ~ kept and * escaped."""
    plain = F.coalesce(F.try_url_decode(text), text)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize_url(url: Column) -> Column:
    """Form for comparing: host and scheme lower-cased, locale blogs as /blog/, no fragment, no utm_ parameters, no slash at the end."""
    p = F.regexp_replace(path(url), "(?i)/blog-[a-z]{2}(?:-[a-z]{2})?/", "/blog/")
    p = F.regexp_replace(p, "(?i)/[a-z]{2}/blog/", "/blog/")
    p = F.regexp_replace(p, "/+$", "")
    p = F.when(p == "", "/").otherwise(p)
    pairs = F.filter(F.split(query(url), "&"), lambda x: (x != "") & ~F.startswith(F.lower(x), F.lit("utm_")))
    pairs = F.transform(pairs, lambda x: F.concat(_form(F.regexp_extract(x, "^([^=]*)", 1)), F.lit("="), _form(F.regexp_extract(x, "^[^=]*=(.*)$", 1))))
    q = F.array_join(pairs, "&")
    s = scheme(url)
    return F.concat(F.when(s == "", "https").otherwise(s), F.lit("://"), host(url), p, F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))


def collapse_segments(url: Column) -> Column:
    """The URL with runs of equal path segments collapsed; null if there are none."""
    p = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    q = F.regexp_replace(p, r"/([^/]+)(?:/\1)+(?=/|$)", "/$1")
    head = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    return F.when(p != q, F.concat(head, q, tail))


def resolve(base: Column, href: Column) -> Column:
    """href on the page `base`: absolute, //host, ?query, #fragment, /path, and paths beside the page's with dot segments removed."""
    h = F.trim(href)
    root = F.concat(scheme(base), F.lit("://"), host(base))
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    target = F.regexp_extract(h, "^([^?#]*)", 1)
    rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    joined = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(folder, target))
    parts = F.split(joined, "/")
    # fold the segments: ".." takes the last one away, "." adds none
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))),
    )
    dotted = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(joined.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise(""))
    clean = F.when(joined.rlike(r"(^|/)\.\.?(/|$)"), dotted).otherwise(joined)
    whole_path = F.regexp_extract(base, r"^([^?#]*)", 1)
    return (
        F.when(h == "", base)
        .when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(F.startswith(h, F.lit("//")), F.concat(scheme(base), F.lit(":"), h))
        .when(F.startswith(h, F.lit("?")), F.concat(whole_path, h))
        .when(F.startswith(h, F.lit("#")), F.concat(F.regexp_extract(base, "^([^#]*)", 1), h))
        .otherwise(F.concat(root, clean, rest))
    )


def is_feed_url(url: Column) -> Column:
    return F.lower(url).rlike(r"/rss|/feed|\.xml")


def bad_path(url: Column) -> Column:
    """The first pattern that rules the URL out, null if none does."""
    u = F.lower(url)
    found = F.lit(None).cast("string")
    for p in reversed(C.BAD_PATHS):
        found = F.when(u.rlike(p), F.lit(p)).otherwise(found)
    return found


def segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda x: x != "")


def last_segment(p: Column) -> Column:
    return F.coalesce(F.try_element_at(segments(p), F.lit(-1)), F.lit(""))


def link_priority(url: Column) -> Column:
    """0 a dated page in a research path, 1 another one there, 2 a long slug, 3 the rest."""
    p = path(F.lower(url))
    tokens = F.size(F.split(last_segment(p), "[-_]"))
    return (
        F.when(contains_any(p, C.RESEARCH_PATHS) & p.rlike(r"/20\d{2}/\d{1,2}/"), 0)
        .when(contains_any(p, C.RESEARCH_PATHS), 1)
        .when((F.size(segments(p)) >= 2) & (tokens >= 4), 2)
        .otherwise(3)
    )


def _in_slug(url: Column, words: tuple[str, ...]) -> Column:
    """A word as a whole path segment, or at a segment's start or end before or after a dash."""
    either = "|".join(words)
    return url.rlike(f"/(?:{either})/") | url.rlike(f"/(?:{either})-") | url.rlike(f"-(?:{either})/")


def probable_link(href: Column, text: Column) -> Column:
    """Whether a link probably leads to a research article, from its URL and its anchor text."""
    u, t = F.lower(F.coalesce(href, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    h, p = host(u), F.regexp_replace(path(u), "/+$", "")
    last = last_segment(p)
    tokens = F.size(F.filter(F.split(last, "[-_]"), lambda x: x != ""))
    blog = F.contains(u, F.lit("/blog/")) | h.rlike(r"^(?:blog|research|labs)\.")
    slug = contains_any(p, C.RESEARCH_PATHS) & ~last.isin(*C.JUNK_SLUGS) & (F.char_length(last) >= 6) & ((tokens >= 2) | (F.char_length(last) >= 12))
    return (
        F.when(_in_slug(u, C.NEGATIVE_TERMS) | contains_any(t, [x for x in C.NEGATIVE_TERMS if len(x) > 6]), False)
        .when(_in_slug(u, C.POSITIVE_TERMS) | contains_any(t, C.POSITIVE_TERMS), True)
        .when(blog & u.rlike(r"/20\d{2}/\d{1,2}/"), True)
        .otherwise(slug | ((tokens >= 4) & (F.char_length(last) >= 12)))
    )


def is_root(url: Column) -> Column:
    return F.regexp_replace(path(url), "/+$", "").isin("", "/blog")


def source_label(url: Column) -> Column:
    """The host without www. and without .com wherever it stands; for file names only."""
    return F.replace(F.replace(host(url), F.lit("www.")), F.lit(".com"))
