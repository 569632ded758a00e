"""Expressions over indicators of compromise: extraction, normalisation, filters, validation against a text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import constants as C
from palisade.functions.urls import any_of

PATTERNS = {"hash": C.HASH_PATTERN, "ip": C.IPV4_PATTERN, "url": C.URL_PATTERN, "domain": C.DOMAIN_PATTERN}


def extract(text: Column, kind: str) -> Column:
    return F.regexp_extract_all(text, F.lit("(?i)" + PATTERNS[kind]), 0)


def labelled(kind: str, values: Column) -> Column:
    """array<struct<kind, value>> of the values."""
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def extract_all(text: Column) -> Column:
    """array<struct<kind, value>> of every indicator in the text."""
    return F.flatten(F.array(*[labelled(k, extract(text, k)) for k in PATTERNS]))


def fang(text: Column) -> Column:
    """[.] to ., [:] to :, hxxp to http, [/ to /."""
    steps = (("[.]", "."), ("[:]", ":"), ("hxxp://", "http://"), ("hxxps://", "https://"), ("[/", "/"))
    return reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), steps, text)


def defang(text: Column) -> Column:
    return F.regexp_replace(text, r"(\w)\.(\w)", "$1[.]$2")


def strip_markdown_link(text: Column) -> Column:
    """[label](http...) to label; white space around a value that is nothing else goes as well."""
    link = r"\[([^\]]+)\]\(https?://[^)]+\)"
    return F.regexp_replace(F.regexp_replace(text, rf"^\s*{link}\s*$", "$1"), link, "$1")


def hashes_of(text: Column) -> Column:
    """The hashes in one value: what follows an algorithm's name, else any embedded one of 32, 40 or 64 digits; lower case."""
    s = F.trim(text)
    whole = F.lower(F.regexp_extract(s, r"(?i)^(?:(?:MD5|SHA-?1|SHA-?256|SHA-?512)\W*)?([0-9a-f]+)$", 1))
    inside = F.transform(F.regexp_extract_all(s, F.lit(r"(?i)\b([0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})\b"), 1), F.lower)
    return F.when(whole == "", inside).when(F.char_length(whole).isin(32, 40, 64), F.array(whole)).otherwise(F.array().cast("array<string>"))


def normalize_hashes(values: Column) -> Column:
    kept = F.filter(values, lambda v: v.isNotNull())
    return F.array_distinct(F.flatten(F.transform(kept, hashes_of)))


def reserved_ip(value: Column) -> Column:
    """Private, loopback, link-local, multicast, broadcast or impossible IPv4 (defanged or with a port too); anything else is not."""
    plain = F.trim(F.replace(value, F.lit("[.]"), F.lit(".")))
    quad = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?::\d+)?$"
    a, b, c, d = (F.regexp_extract(plain, quad, i).try_cast("int") for i in (1, 2, 3, 4))
    private = (a == 10) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
    special = (a == 127) | ((a == 169) & (b == 254)) | a.between(224, 239) | a.isin(0, 255)
    return F.coalesce(private | special | (F.greatest(a, b, c, d) > 255), F.lit(False))


def placeholder(value: Column) -> Column:
    """A value that stands for nothing: empty, a schema hint, or copied from an example."""
    s = F.trim(F.coalesce(value, F.lit("")))
    low = F.lower(s)
    single = F.replace(low, F.lit("\\\\"), F.lit("\\"))
    empty = s.isin("", "[]", "{}", '""', "''")
    starts = s.rlike("(?i)^(?:" + "|".join(C.PLACEHOLDER_STARTS) + ")")
    copied = any_of([F.contains(single, F.lit(x.lower())) for x in C.CONTAMINATION])
    return empty | starts | copied | s.rlike("(?i)(?:deadbeef){4,}")


def without_placeholders(values: Column) -> Column:
    return F.filter(values, lambda v: ~placeholder(v))


def distinct_ignoring_case(values: Column) -> Column:
    """Trimmed, in order, the first spelling of each value."""
    trimmed = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    keyed = F.array_sort(F.transform(trimmed, lambda v, i: F.struct(F.lower(v).alias("k"), i.alias("i"), v.alias("v"))))
    firsts = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["k"] != x["k"]))
    # within a list of one, so that the lambda sees the sorted array as a value, not as an expression to evaluate again
    first = F.get(F.transform(F.array(keyed), firsts), 0)
    return F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v")))), lambda x: x["v"])


def as_list(text: Column) -> Column:
    """The list that a string stands for: [a, b], lines with dashes, or one value."""
    s = F.trim(text)
    unquoted = lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), '^"+|"+$', ""), "^'+|'+$", "")
    flow = F.transform(F.filter(F.split(F.substring(s, F.lit(2), F.char_length(s) - 2), ","), lambda x: F.trim(x) != ""), unquoted)
    block = F.filter(F.transform(F.split(s, "\n"), lambda x: F.trim(F.regexp_replace(F.trim(x), "^-", ""))), lambda x: x != "")
    none = F.array().cast("array<string>")
    return (
        F.when(s.isNull() | s.isin("", "[]", '""', "''"), none)
        .when(F.startswith(s, F.lit("[")) & F.endswith(s, F.lit("]")), flow)
        .when(F.contains(s, F.lit("\n")) | F.startswith(s, F.lit("-")), block)
        .otherwise(F.array(s))
    )


def in_source(source: Column, value: Column) -> Column:
    """Whether the value occurs in the text, either of them with or without brackets around its dots."""
    src, v = F.lower(source), F.lower(F.trim(value))
    open_src, open_v = fang(src), fang(v)
    return (v == "") | F.contains(src, v) | F.contains(open_src, v) | F.contains(src, open_v) | F.contains(open_src, open_v) | F.contains(src, defang(v))


def in_source_windows(source: Column, value: Column, width: int = 20) -> Column:
    """in_source, or any window of `width` characters (half of them letters or digits), every width / 2, occurs in it."""
    src, v = F.lower(source), F.lower(F.trim(value))
    open_src = fang(src)
    starts = F.when(F.char_length(v) >= width, F.sequence(F.lit(1), F.char_length(v) - (width - 1), F.lit(width // 2))).otherwise(F.array().cast("array<int>"))
    part = lambda i: F.substring(v, i, F.lit(width))
    enough = lambda w: F.regexp_count(w, F.lit(r"[\p{L}\p{N}]")) >= width / 2
    return in_source(source, value) | F.exists(starts, lambda i: enough(part(i)) & (F.contains(src, part(i)) | F.contains(open_src, part(i))))


def malware_slug(families: Column) -> Column:
    """File-name part from the first family: lower case, dashes for spaces, nothing but letters, digits and dashes."""
    first = F.lower(F.coalesce(F.get(families, 0), F.lit("")))
    slug = F.regexp_replace(F.replace(first, F.lit(" "), F.lit("-")), "[^a-z0-9-]", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown"))
