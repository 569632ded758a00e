"""Named queries over the standard tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade import constants as C
from palisade import scratch
from palisade.functions import indicators, responses, text, urls
from palisade.operators import links, merge

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task where each row takes milliseconds.
ROWS_A_TASK = 10_000


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over tasks: a file of narrow rows is read by few, however long their rows take afterwards."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // ROWS_A_TASK)))


def _sql_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# --- pieces of SQL -----------------------------------------------------------------------------------------------
CLEAN = r"regexp_replace(strip_accents({0}), '[^\x20-\x7e]', '', 'g')"
HOST = r"lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH = r"regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERY = r"regexp_extract({0}, '^[^?#]*\?([^#]*)', 1)"
_INDICATORS = " OR ".join("regexp_matches({0}, '(?i)" + p + "')" for p in (C.HASH_PATTERN, C.IPV4_PATTERN, C.URL_PATTERN, C.DOMAIN_PATTERN))


def score_sql(t: str) -> str:
    words = f"list_sum([CAST(contains({t}, k) AS INT) FOR k IN {_sql_list(C.GATE_KEYWORDS)}])"
    return f"({words} + 2 * CAST(regexp_matches({t}, '{C.CVE_PATTERN}') AS INT) + 2 * CAST(({_INDICATORS.replace('{0}', t)}) AS INT))"


NORMAL_PATH = rf"regexp_replace(regexp_replace(regexp_replace({PATH.format('url')}, '/blog-[a-zA-Z]{{2}}(?:-[a-zA-Z]{{2}})?/', '/blog/', 'g'), '/[a-zA-Z]{{2}}/blog/', '/blog/', 'g'), '/+$', '')"
NORMAL_QUERY = rf"array_to_string([CASE WHEN contains(x, '=') THEN x ELSE x || '=' END FOR x IN string_split({QUERY.format('url')}, '&') IF x <> '' AND NOT starts_with(lower(x), 'utm_')], '&')"
NORMAL = rf"lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || {HOST.format('url')} || CASE WHEN {NORMAL_PATH} = '' THEN '/' ELSE {NORMAL_PATH} END || CASE WHEN {NORMAL_QUERY} = '' THEN '' ELSE '?' || {NORMAL_QUERY} END"


# --- URLs and links ----------------------------------------------------------------------------------------------
@query(f"SELECT page_id, {NORMAL} AS url_norm FROM pages")
def normalize_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("url_norm"))


@query(f"SELECT page_id, {HOST.format('url')} AS host, {PATH.format('url')} AS path, {QUERY.format('url')} AS query FROM pages")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.query(u).alias("query"))


@query(r"SELECT page_id, regexp_matches(lower(url), '/rss|/feed|\.xml') AS is_feed FROM pages")
def feed_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.is_feed_url(F.col("url")).alias("is_feed"))


_BAD_CASE = "CASE " + " ".join(f"WHEN regexp_matches(lower(url), '{p}') THEN '{p}'" for p in C.BAD_PATHS) + " END"


@query(f"SELECT page_id, {_BAD_CASE} AS bad_pattern FROM pages")
def bad_path_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.bad_path(F.col("url")).alias("bad_pattern"))


_SEGMENTS = "[x FOR x IN string_split({0}, '/') IF x <> '']"
_IN_RESEARCH = "(" + " OR ".join(f"contains({{0}}, '{p}')" for p in C.RESEARCH_PATHS) + ")"


def priority_sql(url: str) -> str:
    p = PATH.format(f"lower({url})")
    research, seg = _IN_RESEARCH.replace("{0}", p), _SEGMENTS.replace("{0}", p)
    return rf"CASE WHEN {research} AND regexp_matches({p}, '/20\d{{2}}/\d{{1,2}}/') THEN 0 WHEN {research} THEN 1 WHEN len({seg}) >= 2 AND len(string_split_regex({seg}[-1], '[-_]')) >= 4 THEN 2 ELSE 3 END"


@query(f"SELECT page_id, {priority_sql('url')} AS priority FROM pages")
def link_priority(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.link_priority(F.col("url")).alias("priority"))


#: Hrefs with a domain of their own are made from the anchor's text, so that words and dates get into paths.
_ANCHORS = """(SELECT page_id, url, 'https://blog.example.test/' || page_id % 7 || CASE page_id % 3 WHEN 0 THEN '/research/' WHEN 1 THEN '/2024/05/' ELSE '/' END || lower(regexp_replace(t, '[^A-Za-z0-9]+', '-', 'g')) || CASE page_id % 4 WHEN 0 THEN '/' ELSE '' END AS href, t
  FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<h1>([^<]{1,60})', 1)) AS t FROM pages))"""


def probable_sql() -> str:
    u, t, h = "lower(href)", "lower(t)", HOST.format("href")
    p = f"regexp_replace({PATH.format('lower(href)')}, '/+$', '')"
    seg = _SEGMENTS.replace("{0}", p)
    last = f"coalesce({seg}[-1], '')"
    tokens = f"len([x FOR x IN string_split_regex({last}, '[-_]') IF x <> ''])"
    slug = lambda words: f"len([k FOR k IN {_sql_list(words)} IF contains({u}, '/' || k || '/') OR contains({u}, '/' || k || '-') OR contains({u}, '-' || k || '/')]) > 0"
    anchor = lambda words: f"len([k FOR k IN {_sql_list(words)} IF contains({t}, k)]) > 0"
    junk = ", ".join(f"'{x}'" for x in C.JUNK_SLUGS)
    return rf"""CASE WHEN {slug(C.NEGATIVE_TERMS)} OR {anchor(tuple(x for x in C.NEGATIVE_TERMS if len(x) > 6))} THEN false
      WHEN {slug(C.POSITIVE_TERMS)} OR {anchor(C.POSITIVE_TERMS)} THEN true
      WHEN (contains({u}, '/blog/') OR regexp_matches({h}, '^(?:blog|research|labs)\.')) AND regexp_matches({u}, '/20\d{{2}}/\d{{1,2}}/') THEN true
      ELSE ({_IN_RESEARCH.replace('{0}', p)} AND {last} NOT IN ({junk}) AND length({last}) >= 6 AND ({tokens} >= 2 OR length({last}) >= 12)) OR ({tokens} >= 4 AND length({last}) >= 12) END"""


@query(f"SELECT page_id, href, {probable_sql()} AS probable FROM {_ANCHORS}")
def probable_link(spark, sf_dir):
    title = F.explode(F.regexp_extract_all("html", F.lit("<h1>([^<]{1,60})"), 1)).alias("t")
    a = table(spark, sf_dir, "pages").select("page_id", title)
    place = F.when(F.col("page_id") % 3 == 0, "/research/").when(F.col("page_id") % 3 == 1, "/2024/05/").otherwise("/")
    href = F.concat(F.lit("https://blog.example.test/"), (F.col("page_id") % 7).cast("string"), place, F.lower(F.regexp_replace("t", "[^A-Za-z0-9]+", "-")), F.when(F.col("page_id") % 4 == 0, "/").otherwise(""))
    return a.withColumn("href", href).select("page_id", "href", urls.probable_link(F.col("href"), F.col("t")).alias("probable"))


_SAME_HOST = rf"""SELECT DISTINCT page_id, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || {HOST.format('url')} || regexp_replace(regexp_extract(href, '^([^?#]*)', 1), '/+$', '') AS link
  FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href FROM pages) WHERE starts_with(href, '/') AND NOT starts_with(href, '//') AND regexp_replace(href, '/+$', '') NOT IN ('', '/blog')"""


@query(_SAME_HOST)
def extract_links(spark, sf_dir):
    return links.page_links(table(spark, sf_dir, "pages").where("url is not null")).select("page_id", "link")


@query(f"""SELECT host, url, priority FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY priority, url) AS n FROM (
  SELECT regexp_replace({HOST.format('url')}, '^[^.]*\\.', '') AS host, url, {priority_sql('url')} AS priority FROM pages)) WHERE n <= {C.MAX_ARTICLES_PER_SOURCE}""")
def top_k_per_source(spark, sf_dir):
    u = F.col("url")
    pages = table(spark, sf_dir, "pages").select(F.regexp_replace(urls.host(u), r"^[^.]*\.", "").alias("host"), "url")
    return links.top_per_source(pages, "host").select("host", "url", "priority")


@query(f"SELECT page_id, url_norm FROM (SELECT page_id, {NORMAL} AS url_norm FROM pages) p WHERE NOT EXISTS (SELECT 1 FROM (SELECT {NORMAL} AS url_norm FROM pages WHERE page_id % 2 = 0) d WHERE d.url_norm = p.url_norm)")
def anti_join_processed(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("url_norm"))
    return links.unprocessed(pages, pages.where("page_id % 2 = 0"))


_JOINED = rf"CASE WHEN starts_with(href, '//') THEN lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || ':' || href WHEN regexp_matches(href, '^[A-Za-z]+:') THEN href WHEN starts_with(href, '/') THEN lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || {HOST.format('url')} || href ELSE lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || {HOST.format('url')} || CASE WHEN {PATH.format('url')} = '' THEN '/' ELSE regexp_replace({PATH.format('url')}, '[^/]*$', '') END || href END"


@query(f"SELECT page_id, href, {_JOINED} AS link FROM (SELECT page_id, url, unnest(['/a/' || page_id, 'b' || page_id || '.html', '//cdn.example.test/' || page_id, 'https://example.test/x?y=' || page_id]) AS href FROM pages)")
def resolve_links(spark, sf_dir):
    n = F.col("page_id").cast("string")
    hrefs = F.array(F.concat(F.lit("/a/"), n), F.concat(F.lit("b"), n, F.lit(".html")), F.concat(F.lit("//cdn.example.test/"), n), F.concat(F.lit("https://example.test/x?y="), n))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(hrefs).alias("href"))
    return pages.select("page_id", "href", urls.resolve(F.col("url"), F.col("href")).alias("link"))


@query(r"SELECT page_id, 'https://example.test' || list_reduce(list_prepend('', parts), lambda acc, x: CASE WHEN ends_with(acc, '/' || x) THEN acc ELSE acc || '/' || x END) AS collapsed FROM (SELECT page_id, ['a', 'b' || page_id % 3, 'b' || page_id % 2, 'c', 'c', 'd'] AS parts FROM pages)")
def collapse_segments(spark, sf_dir):
    n = F.col("page_id")
    parts = F.concat(F.lit("https://example.test/a/b"), (n % 3).cast("string"), F.lit("/b"), (n % 2).cast("string"), F.lit("/c/c/d"))
    return table(spark, sf_dir, "pages").select("page_id", urls.collapse_segments(parts).alias("collapsed"))


# --- texts -------------------------------------------------------------------------------------------------------
@query(f"SELECT doc_id, {CLEAN.format('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, CAST({score_sql('t')} AS INT) AS score, {score_sql('t')} >= 2 AS is_report FROM (SELECT doc_id, lower({CLEAN.format('text')}) AS t FROM documents)")
def security_gate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("t"))
    s = text.gate_score(F.col("t"))
    return docs.select("doc_id", s.alias("score"), (s >= C.GATE_MIN_SCORE).alias("is_report"))


@query("SELECT doc_id, CAST(i AS INT) AS chunk_idx, substr(text, i * 16500 + 1, 18000) AS chunk FROM (SELECT doc_id, text, unnest(generate_series(0, CAST(floor((length(text) - 1) / 16500) AS BIGINT))) AS i FROM documents WHERE length(text) > 0)")
def chunk_explode(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk_idx", "chunk"))


_KINDS = {"hash": C.HASH_PATTERN, "ip": C.IPV4_PATTERN, "url": C.URL_PATTERN, "domain": C.DOMAIN_PATTERN}
_EXTRACTED = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(t, '(?i){p}')) AS value FROM d" for k, p in _KINDS.items())


@query(f"WITH d AS (SELECT doc_id, {CLEAN.format('text')} AS t FROM documents) {_EXTRACTED}")
def extract_iocs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("t"))
    return docs.select("doc_id", F.explode(indicators.extract_all(F.col("t"))).alias("x")).select("doc_id", "x.kind", "x.value")


@query(f"WITH d AS (SELECT page_id AS doc_id, {CLEAN.format('body')} AS t FROM (SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g') AS body FROM pages)), g AS (SELECT * FROM d WHERE {score_sql('lower(t)')} >= 2), x AS ({_EXTRACTED.replace('FROM d', 'FROM g')}) SELECT kind, count(*) AS n, count(DISTINCT value) AS n_values FROM x GROUP BY kind")
def indicator_counts(spark, sf_dir):
    """The flagship: pages to article text, cleaned, gated, indicators counted by kind."""
    body = F.regexp_replace(F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1), "<[^>]*>", " ")
    docs = table(spark, sf_dir, "pages").select(text.clean_text(body).alias("t"))
    gated = docs.where(text.gate_score(F.col("t")) >= C.GATE_MIN_SCORE)
    found = gated.select(F.explode(indicators.extract_all(F.col("t"))).alias("x")).select("x.*")
    return found.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


_LETTERS = r"len(regexp_extract_all(s, '\p{L}'))"
_WORDS = r"[w FOR w IN string_split_regex(s, '\s+') IF w <> '']"


@query(rf"""WITH d AS (SELECT doc_id, regexp_replace({CLEAN.format('text')}, '^\s+|\s+$', '', 'g') AS s FROM documents), w AS (SELECT *, {_WORDS} AS ws FROM d)
SELECT doc_id, length(s) >= 20 AND {_LETTERS} >= 0.3 * length(s) AND ({' OR '.join(f"regexp_matches(s, '(?i){p}')" for p in C.TECHNICAL_PATTERNS)}
  OR (len([x FOR x IN ws IF length(x) = 1]) <= 0.4 * len(ws) AND len([x FOR x IN ws IF length(x) > 2]) >= 3 AND list_sum([length(x) FOR x IN ws]) <= 25 * len(ws))) AS readable FROM w""")
def ocr_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("t"))
    return docs.select("doc_id", text.readable(F.col("t")).alias("readable"))


@query(f"SELECT doc_id, CAST(ceil(length(text) / 3.0) AS BIGINT) AS tokens, ceil(length(text) / 3.0) > {C.MAX_INPUT_TOKENS} AS too_long FROM documents")
def token_guard(spark, sf_dir):
    t = text.estimated_tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", t.alias("tokens"), (t > C.MAX_INPUT_TOKENS).alias("too_long"))


# --- indicators --------------------------------------------------------------------------------------------------
@query(r"""WITH v AS (SELECT doc_id, unnest(['SHA256: ' || sha256(CAST(doc_id AS VARCHAR)), 'md5|' || upper(md5(CAST(doc_id AS VARCHAR))), 'file ' || md5('x' || doc_id) || ' seen', 'abc' || doc_id]) AS s FROM documents),
n AS (SELECT doc_id, lower(regexp_extract(s, '(?i)^(?:(?:MD5|SHA-?1|SHA-?256|SHA-?512)\W*)?([0-9a-f]+)$', 1)) AS whole, s FROM v)
SELECT doc_id, CASE WHEN length(whole) IN (32, 40, 64) THEN whole ELSE lower(regexp_extract(s, '(?i)\b([0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})\b', 1)) END AS hash FROM n WHERE length(whole) IN (32, 40, 64) OR (whole = '' AND regexp_matches(s, '(?i)\b([0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})\b'))""")
def normalize_hashes(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    digest = lambda x: F.md5(x.cast("binary"))
    values = F.array(F.concat(F.lit("SHA256: "), F.sha2(n.cast("binary"), 256)), F.concat(F.lit("md5|"), F.upper(digest(n))), F.concat(F.lit("file "), digest(F.concat(F.lit("x"), n)), F.lit(" seen")), F.concat(F.lit("abc"), n))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(indicators.normalize_hashes(values)).alias("hash"))


_OCTET = "TRY_CAST(regexp_extract(p, '^(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})(?::\\d+)?$', {0}) AS INT)"


@query(f"""WITH v AS (SELECT DISTINCT s_suppkey, ip FROM (SELECT s_suppkey, unnest([s_suppkey % 260 || '.' || s_nationkey || '.1.9', '172.' || s_suppkey % 40 || '.0.1:80', '192[.]168[.]' || s_suppkey || '[.]7', '2001:db8::' || s_suppkey]) AS ip FROM supplier)),
o AS (SELECT *, {', '.join(_OCTET.format(i) + f' AS o{i}' for i in (1, 2, 3, 4))} FROM (SELECT *, replace(ip, '[.]', '.') AS p FROM v))
SELECT s_suppkey, ip, coalesce(o1 = 10 OR (o1 = 172 AND o2 BETWEEN 16 AND 31) OR (o1 = 192 AND o2 = 168) OR o1 = 127 OR (o1 = 169 AND o2 = 254) OR o1 BETWEEN 224 AND 239 OR o1 IN (0, 255) OR greatest(o1, o2, o3, o4) > 255, false) AS reserved FROM o""")
def reserved_ip(spark, sf_dir):
    n, k = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    ips = F.array(F.concat((n % 260).cast("string"), F.lit("."), k, F.lit(".1.9")), F.concat(F.lit("172."), (n % 40).cast("string"), F.lit(".0.1:80")), F.concat(F.lit("192[.]168[.]"), n.cast("string"), F.lit("[.]7")), F.concat(F.lit("2001:db8::"), n.cast("string")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(ips).alias("ip")).distinct().select("s_suppkey", "ip", indicators.reserved_ip(F.col("ip")).alias("reserved"))


@query(r"SELECT doc_id, replace(replace(d, '[.]', '.'), '[:]', ':') AS fanged, d AS defanged FROM (SELECT doc_id, regexp_replace('www.' || source || '.example.test', '(\w)\.(\w)', '\1[.]\2', 'g') AS d FROM documents)")
def fang_defang(spark, sf_dir):
    d = indicators.defang(F.concat(F.lit("www."), F.col("source"), F.lit(".example.test")))
    return table(spark, sf_dir, "documents").select("doc_id", d.alias("defanged")).withColumn("fanged", indicators.fang(F.col("defanged")))


_STARTS = "(?i)^(?:" + "|".join(C.PLACEHOLDER_STARTS) + ")"
_COPIED = " OR ".join(f"contains(lower(v), '{x.lower()}')" for x in C.CONTAMINATION)


@query(f"""SELECT doc_id, v, v IN ('', '[]') OR regexp_matches(v, '{_STARTS}') OR {_COPIED} AS placeholder FROM (
  SELECT doc_id, unnest([source, CASE doc_id % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN 'Unknown' WHEN 2 THEN '<author name>' WHEN 3 THEN 'unknown actor' ELSE '' END, 'x' || repeat('0', CAST(doc_id % 40 AS INT))]) AS v FROM documents)""")
def placeholder_filter(spark, sf_dir):
    n = F.col("doc_id")
    made = F.when(n % 5 == 0, "N/A").when(n % 5 == 1, "Unknown").when(n % 5 == 2, "<author name>").when(n % 5 == 3, "unknown actor").otherwise("")
    v = F.array("source", made, F.concat(F.lit("x"), F.repeat(F.lit("0"), (n % 40).cast("int"))))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(v).alias("v")).select("doc_id", "v", indicators.placeholder(F.col("v")).alias("placeholder"))


@query(r"""WITH t AS (SELECT conv_id, turn, unnest(string_split_regex(text, '[^A-Za-z]+')) AS w, unnest(generate_series(1, len(string_split_regex(text, '[^A-Za-z]+')))) AS i FROM conversations)
SELECT conv_id, turn, array_to_string(list(w ORDER BY i), ',') AS words FROM (SELECT conv_id, turn, arg_min(w, i) AS w, min(i) AS i FROM t WHERE w <> '' GROUP BY conv_id, turn, lower(w)) GROUP BY conv_id, turn""")
def dedupe_ci(spark, sf_dir):
    words = indicators.distinct_ignoring_case(F.split("text", "[^A-Za-z]+"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(words, ",").alias("words")).where("words <> ''")


@query("""SELECT i.item_id, d.doc_id FROM (SELECT item_id, lower(trim(text)) AS v FROM benchmark) i JOIN (SELECT doc_id, lower(text) AS s FROM documents) d ON contains(d.s, i.v)""")
def occurrences(spark, sf_dir):
    """Which benchmark passages occur in which documents."""
    from palisade.operators.validate import occurrences as found

    return found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("""WITH t AS (SELECT DISTINCT w AS term FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE length(w) >= 6)
SELECT doc_id, term, CAST(strpos(s, term) AS BIGINT) AS first FROM (SELECT doc_id, lower(text) AS s FROM documents) JOIN t ON contains(s, term)""")
def dictionary_terms(spark, sf_dir):
    """Which documents hold which longer words of the benchmark, as parts of words too, and where first."""
    from palisade.operators.dictionary import term_matches

    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where("length(term) >= 6")
    return term_matches(table(spark, sf_dir, "documents"), words).select("doc_id", "term", "first")


def _fang_sql(x: str) -> str:
    return f"replace(replace(replace(replace(replace({x}, '[.]', '.'), '[:]', ':'), 'hxxp://', 'http://'), 'hxxps://', 'https://'), '[/', '/')"


def in_source_sql(v: str) -> str:
    """Whether v (lower-cased) is in s, either of them with or without brackets; fs is s without."""
    defanged = rf"regexp_replace({v}, '(\w)\.(\w)', '\1[.]\2', 'g')"
    return f"({v} = '' OR contains(s, {v}) OR contains(fs, {v}) OR contains(s, {_fang_sql(v)}) OR contains(fs, {_fang_sql(v)}) OR contains(s, {defanged}))"


def in_windows_sql(v: str) -> str:
    part = f"substr({v}, i, 20)"
    found = rf"len(regexp_extract_all({part}, '[\p{{L}}\p{{N}}]')) >= 10 AND (contains(s, {part}) OR contains(fs, {part}))"
    return f"({in_source_sql(v)} OR len([i FOR i IN generate_series(1, length({v}) - 19, 10) IF {found}]) > 0)"


_COMMAND = f"CASE WHEN length(v) > 30 THEN {in_windows_sql('lower(trim(v))')} ELSE {in_source_sql('lower(trim(v))')} END"


@query(f"""WITH d AS (SELECT doc_id, lower(text) AS s, {_fang_sql('lower(text)')} AS fs, [substr(text, 5, 60), 'zq' || substr(text, 5, 50) || 'zq', 'Nothing like QQQ' || doc_id || ' QQQ is in here at all'] AS commands,
  ['x' || doc_id || '.example.test', substr(text, 1, 12), 'www[.]example[.]com', ''] AS domains FROM documents),
v AS (SELECT doc_id, coalesce(s, '') = '' OR {_COMMAND} AS kept, 1 AS command FROM (SELECT *, unnest(commands) AS v FROM d) UNION ALL
  SELECT doc_id, coalesce(s, '') = '' OR {in_source_sql('lower(trim(v))')} AS kept, 0 AS command FROM (SELECT *, unnest(domains) AS v FROM d))
SELECT doc_id, count(*) FILTER (WHERE kept AND command = 1) AS n_commands, count(*) FILTER (WHERE kept AND command = 0) AS n_domains, count(*) FILTER (WHERE NOT kept) AS n_dropped FROM v GROUP BY doc_id""")
def cross_validate(spark, sf_dir):
    """Values held against their own document's text: copied, framed, made up, with brackets; windows of long commands."""
    from palisade.operators.validate import cross_validate as checked

    t = F.col("text")
    commands = F.array(F.substring(t, 5, 60), F.concat(F.lit("zq"), F.substring(t, 5, 50), F.lit("zq")), F.format_string("Nothing like QQQ%d QQQ is in here at all", "doc_id"))
    domains = F.array(F.format_string("x%d.example.test", "doc_id"), F.substring(t, 1, 12), F.lit("www[.]example[.]com"), F.lit(""))
    none = F.array().cast("array<string>")
    ttps = F.struct(*[(commands if f == "command_lines" else none).alias(f) for f in C.TTP_FIELDS])
    iocs = F.struct(*[(domains if f == "domains" else none).alias(f) for f in C.IOC_FIELDS])
    got = checked(table(spark, sf_dir, "documents").select("doc_id", "text", ttps.alias("ttps"), iocs.alias("iocs")), "text")
    return got.select("doc_id", F.size("ttps.command_lines").alias("n_commands"), F.size("iocs.domains").alias("n_domains"), "n_dropped")


# --- merging, records --------------------------------------------------------------------------------------------
@query("""WITH c AS (SELECT conv_id, turn, text, role FROM conversations), f AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE text <> '') AS first_text, arg_min(role, turn) AS first_role, array_to_string(list(role ORDER BY turn), ',') AS roles, count(*) AS n_chunks FROM c GROUP BY conv_id),
best AS (SELECT conv_id, arg_min(text, (-length(text), turn)) AS t, max(length(text)) AS l FROM c WHERE length(text) <= 1000 GROUP BY conv_id)
SELECT f.conv_id, first_text AS title, CASE WHEN l > length(first_text) THEN t ELSE first_text END AS description, CASE WHEN contains(roles, 'system') AND contains(roles, 'user') AND contains(roles, 'assistant') THEN 3 WHEN contains(roles, 'assistant') AND contains(roles, 'user') THEN 2 ELSE len(list_distinct(string_split(roles, ','))) END AS n_roles, n_chunks FROM f LEFT JOIN best USING (conv_id)""")
def merge_fold(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("title"), F.col("text").alias("description"), F.array("role").alias("roles"))
    merged = merge.fold_chunks(chunks, "conv_id", "turn", first=("title",), longest=("description",), lists=("roles",))
    return merged.select("conv_id", "title", "description", F.size("roles").alias("n_roles"), "n_chunks")


@query("SELECT p_partkey, coalesce(nullif(regexp_replace(replace(lower(p_name), ' ', '-'), '[^a-z0-9-]', '', 'g'), ''), 'unknown') AS slug FROM part")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", indicators.malware_slug(F.array("p_name")).alias("slug"))


@query("SELECT d.doc_id, length(text) > 2000 OR coalesce(quality, 0) > 0 OR (lang <> '' AND source = 'src0') AS meaningful FROM documents d LEFT JOIN labels l USING (doc_id)")
def meaningful_content(spark, sf_dir):
    from palisade.operators.records import meaningful

    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    one = lambda test: F.when(F.coalesce(test, F.lit(False)), F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return docs.select("doc_id", meaningful([one(F.char_length("text") > 2000)], [one(F.col("quality") > 0)], F.array().cast("array<string>"), F.col("lang"), one(F.col("source") == "src0")).alias("meaningful"))


@query(f"""SELECT w, h, CASE WHEN w < 200 OR h < 100 THEN 'too small' WHEN w > 3000 OR h > 3000 THEN 'too large' WHEN w / h > 8 OR w / h < 0.2 THEN 'extreme aspect ratio' WHEN w BETWEEN 180 AND 400 AND h BETWEEN 180 AND 400 AND abs(w - h) < 60 THEN 'likely logo' END AS reason
  FROM (SELECT DISTINCT CAST(p_size * 70 AS INT) AS w, CAST((p_partkey * 37) % 3300 AS INT) AS h FROM part)""")
def image_filter(spark, sf_dir):
    sizes = table(spark, sf_dir, "part").select((F.col("p_size") * 70).cast("int").alias("w"), ((F.col("p_partkey") * 37) % 3300).cast("int").alias("h")).distinct()
    return sizes.select("w", "h", F.regexp_extract(text.image_reason(F.col("w"), F.col("h")), r"^([^(]*[^( ])", 1).alias("reason"))


# --- events: time, state, JSON -----------------------------------------------------------------------------------
@query("SELECT event_id FROM events WHERE ts IS NULL OR CAST(ts AS DATE) >= DATE '2024-01-30' - 7")
def recency_filter(spark, sf_dir):
    from palisade.functions.dates import recent

    return table(spark, sf_dir, "events").where(recent(F.col("ts"), F.lit("2024-01-30").cast("date"))).select("event_id")


@query("SELECT event_id, greatest(0.0, 2.0 - coalesce(epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2.0)) > 0 AS waits FROM events")
def domain_throttle(spark, sf_dir):
    from palisade.operators.throttle import waits

    return waits(table(spark, sf_dir, "events"), "user_id", "ts", C.REQUEST_DELAY, tie="event_id").select("event_id", (F.col("wait") > 0).alias("waits"))


@query("SELECT event_id, greatest(0.0, 2.0 - coalesce(epoch(ts) - lag(epoch(ts)) OVER (ORDER BY ts, event_id), 2.0)) > 0 AS waits FROM events")
def global_throttle(spark, sf_dir):
    from palisade.operators.throttle import waits

    return waits(table(spark, sf_dir, "events"), None, "ts", C.REQUEST_DELAY, tie="event_id").select("event_id", (F.col("wait") > 0).alias("waits"))


@query("""SELECT user_id, count(DISTINCT s) AS n_sessions, max(n) AS longest FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS g FROM events)) GROUP BY user_id, s) GROUP BY user_id""")
def session_counts(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.coalesce((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp")) > 1_800_000_000).cast("int"), F.lit(0))
    s = table(spark, sf_dir, "events").withColumn("g", gap).withColumn("s", F.sum("g").over(w))
    return s.groupBy("user_id", "s").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, false AS dead FROM events WHERE event_id % 10 <> 0 UNION ALL SELECT event_id, NULL, true FROM events WHERE event_id % 10 = 0")
def dead_letter_split(spark, sf_dir):
    from palisade.operators.records import parsed

    raw = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return parsed(table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "raw", "k int").select("event_id", "value.k", "dead")


@query("SELECT event_id, provider, event_type AS reply FROM events, (SELECT unnest(['claude', 'gemini', 'lmstudio', 'ollama', 'openai']) AS provider)")
def json_response_paths(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    said = F.struct(F.col("event_type").alias("content"))
    part = F.struct(F.col("event_type").alias("text"))
    bodies = {
        "openai": F.struct(F.array(F.struct(said.alias("message"))).alias("choices")),
        "lmstudio": F.struct(F.array(F.struct(said.alias("message"))).alias("choices")),
        "ollama": F.struct(said.alias("message")),
        "claude": F.struct(F.array(part).alias("content")),
        "gemini": F.struct(F.array(F.struct(F.struct(F.array(part).alias("parts")).alias("content"))).alias("candidates")),
    }
    replies = F.array(*[F.struct(F.lit(p).alias("provider"), responses.reply_text(F.to_json(b), p).alias("reply")) for p, b in bodies.items()])
    return e.select("event_id", F.inline(replies))


@query("SELECT lang, source, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars, count(quality) AS n_labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang, source), (lang), ())")
def corpus_rollup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.groupingSets([["lang", "source"], ["lang"], []], "lang", "source").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.count("quality").alias("n_labelled"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 10) AS n_large, count(*) FILTER (WHERE props IS NULL) AS n_empty FROM events GROUP BY event_type")
def rule_counters(spark, sf_dir):
    """Counters of what each rule lets through, as one grouped pass."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("n_large"), F.count_if(F.col("props").isNull()).alias("n_empty"))


@query(f"""WITH p AS (SELECT page_id, url, regexp_replace({HOST.format('url')}, '^[^.]*\\.', '') AS source, {NORMAL} AS url_norm, {_BAD_CASE} AS bad, regexp_replace({PATH.format('url')}, '/+$', '') IN ('', '/blog') AS root FROM pages)
SELECT source, count(*) AS n_links, count(*) FILTER (WHERE url_norm IN (SELECT url_norm FROM p WHERE page_id % 2 = 0)) AS n_processed, count(bad) AS n_bad_path, count(*) FILTER (WHERE root) AS n_roots FROM p WHERE url IS NOT NULL GROUP BY source""")
def link_counters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").where("url is not null")
    seen = pages.select(F.regexp_replace(urls.host(F.col("url")), r"^[^.]*\.", "").alias("source"), "url")
    processed = pages.where("page_id % 2 = 0").select(urls.normalize_url(F.col("url")).alias("url_norm"))
    return links.link_counters(seen, processed)


# --- answers, pages, feeds, streams ------------------------------------------------------------------------------


def _answers(parts: DataFrame) -> DataFrame:
    """Made-up answers: fenced with a colon in the title, with tabs, with a colon only."""
    colon = F.when(F.col("p_partkey") % 3 == 1, "").otherwise(":")
    doc = F.format_string("title: Report%s %s\niocs:\n  domains:\n  - %s.example.test\n  - 10.0.0.%d\nmalware_families: [%s]\n", colon, "p_name", F.replace("p_name", F.lit(" "), F.lit("-")), (F.col("p_partkey") % 250).cast("int"), "p_type")
    n = F.col("p_partkey") % 3
    raw = F.when(n == 0, F.concat(F.lit("Sure:\n```yaml\n"), doc, F.lit("```"))).when(n == 1, F.replace(doc, F.lit("  - "), F.lit("\t- "))).otherwise(doc)
    return parts.select("p_partkey", raw.alias("raw"))


@query("SELECT p_partkey, 'Report' || CASE p_partkey % 3 WHEN 1 THEN ' ' ELSE ': ' END || p_name AS title, replace(p_name, ' ', '-') || '.example.test' AS first_domain, 2 AS n_domains FROM part")
def yaml_answers(spark, sf_dir):
    from palisade.operators.yaml_repair import answer_json

    a = _answers(table(spark, sf_dir, "part")).withColumn("doc", answer_json("raw"))
    get = lambda p: F.get_json_object("doc", p)
    return a.select("p_partkey", get("$.title").alias("title"), get("$.iocs.domains[0]").alias("first_domain"), F.json_array_length(get("$.iocs.domains")).alias("n_domains"))


@query("SELECT p_partkey, 'Report' || CASE p_partkey % 3 WHEN 1 THEN ' ' ELSE ': ' END || p_name AS title, replace(p_name, ' ', '-') || '.example.test,10.0.0.' || p_partkey % 250 AS domains, p_type AS family FROM part")
def normalize_records(spark, sf_dir):
    from palisade.operators import records
    from palisade.operators.yaml_repair import answer_json

    r = records.normalize(_answers(table(spark, sf_dir, "part")).select("p_partkey", answer_json("raw").alias("document")))
    return r.select("p_partkey", "title", F.array_join("iocs.domains", ",").alias("domains"), F.get("malware_families", 0).alias("family"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'CVE-2024-1,CVE-2024-' || p_partkey || CASE WHEN p_partkey = 1 THEN '' ELSE ',CVE-2023-7' END WHEN 1 THEN 'CVE-2024-' || p_partkey ELSE 'CVE-2024-1' END AS cves,
  CASE p_partkey % 3 WHEN 0 THEN 'run ' || p_brand || ',run ' || p_type WHEN 1 THEN 'run ' || p_type ELSE 'run ' || p_brand END AS commands,
  'HKCU\\' || p_brand AS keys, CASE p_partkey % 3 WHEN 2 THEN 'a' || p_partkey || '.example.test' ELSE '' END AS domains, CASE WHEN p_partkey % 3 = 0 THEN 'x' || p_size ELSE '' END AS extra FROM part""")
def mixed_names(spark, sf_dir):
    """Records of mixed models: lists under old and new names, misplaced fields, lists as text, a flat list of indicators, a key beyond the schema."""
    from palisade.operators import records

    n, kind = F.col("p_partkey").cast("string"), F.col("p_partkey") % 3
    cve, run, brand = F.concat(F.lit("CVE-2024-"), n), F.concat(F.lit("run "), "p_type"), F.concat(F.lit("run "), "p_brand")
    key = F.concat(F.lit("HKCU\\"), "p_brand")
    both = F.struct(
        F.array(F.lit("CVE-2024-1"), cve).alias("cves"), F.array(F.lit("CVE-2024-1"), F.lit("CVE-2023-7")).alias("CVEs"),
        F.struct(F.array(brand).alias("command_lines"), F.array(run, brand).alias("commandline")).alias("TTPs"), F.array(key).alias("registry_keys"), F.concat(F.lit("x"), "p_size").alias("note"),
    )
    old = F.struct(F.concat(F.lit("- "), cve, F.lit("\n- N/A")).alias("CVEs"), F.array(run).alias("commandline"), F.struct(key.alias("registry_keys")).alias("ttps"))
    flat = F.struct(F.concat(F.lit("['CVE-2024-1', ]")).alias("cves"), F.array(F.concat(F.lit("a"), n, F.lit(".example.test")), F.lit("10.0.0.1")).alias("iocs"), F.struct(F.array(brand).alias("command_line"), F.array(key).alias("registry_keys")).alias("TTPs"))
    doc = F.when(kind == 0, F.to_json(both)).when(kind == 1, F.to_json(old)).otherwise(F.to_json(flat))
    r = records.normalize(table(spark, sf_dir, "part").select("p_partkey", doc.alias("document")))
    joined = lambda c, name: F.array_join(c, ",").alias(name)
    extra = F.coalesce(F.try_variant_get("extras", "$.note", "string"), F.lit("")).alias("extra")
    return r.select("p_partkey", joined("cves", "cves"), joined("ttps.command_lines", "commands"), joined("ttps.registry_keys", "keys"), joined("iocs.domains", "domains"), extra)


@query(r"SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, len(regexp_extract_all(html, '<a [^>]*href=\"')) AS n_links FROM pages")
def page_parts(spark, sf_dir):
    from palisade.operators.html import page_parts as parts

    p = table(spark, sf_dir, "pages").select("page_id", "html", parts("html").alias("p"))
    return p.select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), F.size("p.links").alias("n_links"))


@query()
def article_texts(spark, sf_dir):
    """Pages to gated article texts with dates; SQL has no HTML parser."""
    from palisade.plans.articles import articles

    pages = spread(table(spark, sf_dir, "pages").select("url", F.col("html").alias("body")))
    return articles(pages, None, F.lit("2024-01-30").cast("date")).withColumn("n_chars", F.char_length("text")).drop("text")


_WORDS_OF = "'The malware of ' || p_name || ' runs a backdoor, and its payload runs again.'"


@query(f"""SELECT 'https://blog.example.test/2024/02/' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || '/x' || p_partkey AS url,
  '=== ARTICLE BODY ===' || p_name || CASE WHEN p_partkey % 5 = 4 THEN repeat({_WORDS_OF}, 6) ELSE {_WORDS_OF} END || 'run ' || p_type || CASE WHEN p_partkey % 4 = 0 THEN 'k' || p_brand ELSE '' END
    || '=== CODE BLOCKS ===run ' || p_type || '=== TABLES ===' || CASE WHEN p_partkey % 4 = 0 THEN 'k' || p_brand ELSE '' END AS text,
  CASE WHEN p_partkey % 3 = 0 THEN '2023-05-06' WHEN p_partkey % 3 = 1 THEN '2022-07-08' ELSE CAST(DATE '2024-02-01' + CAST(p_partkey % 28 AS INT) AS VARCHAR) END AS published,
  CASE p_partkey % 3 WHEN 0 THEN 'time' WHEN 1 THEN 'meta' ELSE 'url' END AS date_source, true AS report FROM part""")
def made_articles(spark, sf_dir):
    """Pages of five layouts (article, main, a role, a content class, nothing that tells) to texts and dates, navigation left out."""
    from palisade.plans.articles import articles

    n = F.col("p_partkey")
    said = F.concat(F.lit("The malware of "), "p_name", F.lit(" runs a backdoor, and its payload runs again."))
    grid = F.when(n % 4 == 0, F.concat(F.lit("<table><tr><th>k</th><td>"), "p_brand", F.lit("</td></tr></table>"))).otherwise("")
    paragraph = F.concat(F.lit("<p>"), said, F.lit("</p>"))
    inside = F.concat(F.lit("<h1>"), "p_name", F.lit("</h1>"), F.when(n % 5 == 4, F.repeat(paragraph, F.lit(6))).otherwise(paragraph), F.lit("<div class='share-buttons'>tell all</div><pre>run "), "p_type", F.lit("</pre>"), grid)
    elsewhere = "".join(f"<div><a href='/{i}'>More of what others read, {i}</a></div>" for i in range(9))
    layouts = (("<article>", "</article>"), ("<main>", "</main>"), ("<div role='main'>", "</div>"), ("<div class='post-content'>", "</div>"), (f"<div>{elsewhere}</div><div>", f"</div><div>{elsewhere}</div>"))
    body = F.lit(None).cast("string")
    for i, (start, end) in enumerate(layouts):
        body = F.when(n % 5 == i, F.concat(F.lit(start), inside, F.lit(end))).otherwise(body)
    time = F.when(n % 3 == 0, "<time datetime='2023-05-06T01:02:03Z'></time>").otherwise("")
    meta = F.when(n % 3 < 2, "<meta name='date' content='2022-07-08'>").otherwise("")
    html = F.concat(F.lit("<html><head><title>t</title>"), meta, F.lit("</head><body><nav><a href='/n'>elsewhere</a></nav>"), time, body, F.lit("<footer>legal</footer></body></html>"))
    day = F.lpad((n % 28 + 1).cast("string"), 2, "0")
    url = F.concat(F.lit("https://blog.example.test/2024/02/"), day, F.lit("/x"), n.cast("string"))
    made = articles(spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")).select(url.alias("url"), html.alias("body")), None, F.lit("2024-06-30").cast("date"))
    return made.withColumn("published", F.col("published").cast("string"))


@query("""SELECT 'https://e.example.test/' || p_partkey % 7 AS url, string_agg('=== Image ' || (idx + 1) || ': https://img.example.test/' || p_partkey || ' ===' || chr(10) || p_name, chr(10) || chr(10) ORDER BY idx) AS image_text
  FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey % 7 ORDER BY p_partkey) - 1 AS idx FROM part) WHERE p_partkey % 3 <> 0 GROUP BY ALL""")
def image_texts(spark, sf_dir):
    """Texts of each article's images, in order; a third of the images gave none."""
    from palisade.operators.html import image_texts as joined

    p = table(spark, sf_dir, "part")
    url = F.concat(F.lit("https://e.example.test/"), (F.col("p_partkey") % 7).cast("string"))
    image = F.concat(F.lit("https://img.example.test/"), F.col("p_partkey").cast("string"))
    idx = F.row_number().over(Window.partitionBy(F.col("p_partkey") % 7).orderBy("p_partkey")) - 1
    read = p.select(image.alias("image_url"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_name")).alias("text"))
    return joined(p.select(url.alias("url"), idx.alias("idx"), image.alias("image_url")), read)


def _corpus(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a corpus of a record for each part, from 20 sources and 28 days of three months, in one commit."""
    from palisade.operators import records
    from palisade.sources.corpus_source import write_corpus

    n = F.col("p_partkey")
    text = n.cast("string")
    doc = F.to_json(F.struct(F.concat_ws(": ", "p_name", text).alias("title"), F.struct(F.array(F.concat(F.lit("p"), text, F.lit(".example.test"))).alias("domains")).alias("iocs")))
    made = records.normalize(spread(table(spark, sf_dir, "part").select("p_partkey", "p_name")).select("p_partkey", doc.alias("document")))
    day = F.date_add(F.add_months(F.lit("2024-02-01").cast("date"), (n % 3).cast("int")), (n % 28).cast("int"))
    url = F.concat(F.lit("https://www.e"), (n % 20).cast("string"), F.lit(".example.test/"), text)
    folder = scratch.new_folder(spark, "corpus")
    write_corpus(records.enrich(made.withColumn("url", url), "url", day, day.cast("timestamp")), folder)
    return folder


_PART_DAY = "CAST(DATE '2024-02-01' + INTERVAL (p_partkey % 3) MONTH AS DATE) + CAST(p_partkey % 28 AS INT)"


@query(f"""SELECT p_name || ': ' || p_partkey AS title, 'p' || p_partkey || '.example.test' AS domains, 'https://www.e' || p_partkey % 20 || '.example.test/' || p_partkey AS reference, CAST({_PART_DAY} AS VARCHAR) AS published FROM part""")
def yaml_corpus(spark, sf_dir):
    """Records written as YAML, many a file, in one commit, and read back as a corpus."""
    from palisade.sources import corpus, corpus_source

    back = corpus.corpus(corpus_source.documents(corpus_source.read_corpus(spark, _corpus(spark, sf_dir))))
    return back.select("title", F.array_join("iocs.domains", ",").alias("domains"), "reference", F.col("date_of_publication").cast("string").alias("published"))


@query(f"""SELECT 'e' || p_partkey % 20 || '.example.test' AS source, CAST(month({_PART_DAY}) AS INT) AS month, count(*) AS n, max(p_name) AS last FROM part
  WHERE p_partkey % 20 IN (3, 4) AND month({_PART_DAY}) = 3 GROUP BY ALL""")
def corpus_of_a_month(spark, sf_dir):
    """What two sources wrote in a month: only files that may hold it are opened."""
    from palisade.sources import corpus_source

    rows = corpus_source.read_corpus(spark, _corpus(spark, sf_dir)).where("year = 2024 and month = 3 and source in ('e3.example.test', 'e4.example.test')")
    title = F.regexp_extract("text", r"(?m)^title: '?([^:]*):", 1)
    return rows.groupBy("source", "month").agg(F.count("*").alias("n"), F.max(title).alias("last"))


@query("SELECT event_id, 'https://feed.example.test/' || event_id AS link, CAST(date_trunc('second', ts) AS TIMESTAMP) AS published FROM events")
def feed_entries(spark, sf_dir):
    from palisade.sources.feeds import feed_entries as entries

    e = table(spark, sf_dir, "events")
    item = F.format_string("<rss><channel><item><title>t</title><link>https://feed.example.test/%d</link><pubDate>%s +0000</pubDate></item></channel></rss>", "event_id", F.date_format("ts", "dd MMM yyyy HH:mm:ss"))
    return entries(e.select("event_id", item.alias("xml")), source="event_id").select("event_id", "link", F.col("published").cast("timestamp_ntz").alias("published"))


@query("SELECT reference, kind, value_fanged, count(*) AS n FROM (SELECT 'src' || p_partkey % 5 AS reference, 'domains' AS kind, lower(replace(p_name, ' ', '-') || '.example.test') AS value_fanged FROM part) GROUP BY ALL")
def indicator_corpus(spark, sf_dir):
    """Records to indicators, counted by source and fanged value."""
    from palisade.operators import records

    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("[.]example[.]test"))
    doc = F.to_json(F.struct(F.struct(F.array(name).alias("domains")).alias("iocs")))
    r = records.normalize(table(spark, sf_dir, "part").select(F.concat(F.lit("src"), (F.col("p_partkey") % 5).cast("string")).alias("reference"), doc.alias("document")))
    return records.indicators(r).groupBy("reference", "kind", "value_fanged").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf_dir):
    """Each user and event type once, by a stream over the table's files that runs until it has read them all."""
    at = scratch.new_folder(spark, "stream")
    seen = _event_stream(spark, sf_dir).select("user_id", "event_type").dropDuplicates()
    q = seen.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{at}/out")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir.rstrip('/')}/events*")


@query("SELECT DISTINCT 'https://feed.example.test/' || user_id % 50 || '/' || event_type AS url_norm FROM events WHERE ts IS NULL OR CAST(ts AS DATE) >= DATE '2024-01-10'")
def stream_ingest(spark, sf_dir):
    """Feeds as a stream: recent entries once each, added to the processed set batch by batch; read twice, written once."""
    from palisade.sources.processed import ProcessedSet
    from palisade.streaming.ingest import fresh_entries, ingest

    at = scratch.new_folder(spark, "ingest")
    link = F.concat(F.lit("https://feed.example.test/"), (F.col("user_id") % 50).cast("string"), F.lit("/"), "event_type")
    date = F.coalesce(F.concat(F.lit("<pubDate>"), F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>")), F.lit(""))
    xml = F.concat(F.lit("<rss><channel><item><title>t</title><link>"), link, F.lit("</link>"), date, F.lit("</item></channel></rss>"))
    starts = spark.createDataFrame([], "url_norm string")
    for again in range(2):
        feeds = _event_stream(spark, sf_dir).select(F.lit("s").alias("source"), xml.alias("xml"))
        ingest(fresh_entries(feeds, F.lit("2024-01-17").cast("date")), f"{at}/done", starts, f"{at}/state{again}").awaitTermination()
    return ProcessedSet(spark, f"{at}/done").urls().select("url_norm")


@query("""WITH e AS (SELECT user_id, event_id, coalesce(epoch_us(ts) // 1000, 0) AS ms, 'https://u' || user_id || '.example.test/' || event_id AS link FROM events WHERE user_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, link) AS i FROM e),
s AS (SELECT link, max(ms - i * 600000) OVER (PARTITION BY user_id ORDER BY i) + i * 600000 AS slot FROM n)
SELECT link, slot FROM s WHERE slot <= (SELECT max(epoch_us(ts) // 1000) FROM events)""")
def stream_pace(spark, sf_dir):
    """Links of each user's own host, ten minutes apart at least, handed out by timers on the watermark: all whose slots have come."""
    from palisade.streaming.timers import paced_links

    at = scratch.new_folder(spark, "pace")
    link = F.format_string("https://u%d.example.test/%d", "user_id", "event_id")
    stream = _event_stream(spark, sf_dir).where("user_id is not null").select(link.alias("link"), F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", "0 seconds")
    slots = paced_links(stream, 600, ttl=10**9, at="ts").select("link", F.unix_millis("slot").alias("slot"))
    slots.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("link string, slot long").parquet(f"{at}/out")


@query("""SELECT 'https://feed.example.test/' || user_id || '/' || event_type AS url, CAST(count(*) AS INT) AS attempts FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL HAVING count(*) >= 5""")
def stream_dead_letters(spark, sf_dir):
    """Failed links as a stream of outcomes: those that failed five times are dead, the others wait for their retry."""
    from palisade.streaming.timers import retries

    at = scratch.new_folder(spark, "retries")
    url = F.format_string("https://feed.example.test/%d/%s", "user_id", "event_type")
    failed = _event_stream(spark, sf_dir).where("user_id is not null and event_type is not null").select(url.alias("url"), F.lit("failed").alias("outcome"), F.lit("timeout").alias("reason"))
    found = retries(failed, first=3600, attempts=5)
    # one batch: with processing time there is always another one, as timers may be due
    found.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(once=True).start().awaitTermination()
    return spark.read.schema("url string, attempts int, what string, reason string").parquet(f"{at}/out").where("what = 'dead'").select("url", "attempts")


@query("SELECT 'https://e' || event_id || '.example.test/' || event_type AS link, CAST(event_id // 500 AS VARCHAR) AS feed FROM events")
def live_feed_entries(spark, sf_dir):
    """Entries of feeds that are polled twice: they are served from a folder, 500 entries each, and send nothing new the second time."""
    from palisade.sources.feeds import feed_entries as entries
    from palisade.sources.live_feeds import folder_transport, live_feeds

    at = scratch.new_folder(spark, "feeds")
    item = F.format_string("<item><title>t</title><link>https://e%d.example.test/%s</link></item>", "event_id", "event_type")
    e = table(spark, sf_dir, "events").select(F.expr("event_id div 500").alias("feed"), F.col("event_id"), item.alias("item"))
    served = e.groupBy("feed").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda x: x["item"]), "").alias("items"))
    served.select("feed", F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("value")).write.partitionBy("feed").text(f"{at}/served")
    served.select(F.concat(F.lit("https://feeds.example.test/feed="), "feed")).coalesce(1).write.text(f"{at}/list")
    for _ in range(2):
        stream = live_feeds(spark, f"{at}/list", f"{at}/memory", interval=0.001, transport=folder_transport(f"{at}/served"))
        found = entries(stream).select("link", F.regexp_extract("source", r"feed=(\d+)$", 1).alias("feed"))
        found.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("link string, feed string").parquet(f"{at}/out")


@query("""SELECT doc_id, lang, CAST(i AS INT) AS chunk_idx, length(substr(text, i * 900 + 1, 1000)) AS n_chars, md5(substr(text, i * 900 + 1, 1000)) AS digest
  FROM (SELECT doc_id, lang, text, unnest(generate_series(0, CAST(floor((length(text) - 1) / 900) AS BIGINT))) AS i FROM documents WHERE length(text) > 0)""")
def sql_chunks(spark, sf_dir):
    """A table function in SQL: chunks of documents with the columns beside them."""
    from palisade.functions.tables import register

    register(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return spark.sql("SELECT doc_id, lang, chunk_idx, length(chunk) AS n_chars, md5(CAST(chunk AS BINARY)) AS digest FROM text_chunks(TABLE(SELECT * FROM {docs}), 'text', 1000, 100)", docs=docs)


_SQL_KINDS = " UNION ALL ".join(f"SELECT doc_id, lang, '{k}' AS kind, unnest(regexp_extract_all(text, '(?i){p}')) AS value FROM documents" for k, p in _KINDS.items())


@query(f"SELECT doc_id, lang, kind, value, count(*) AS n, count(DISTINCT doc_id) AS n_rows FROM ({_SQL_KINDS}) GROUP BY ALL")
def sql_indicators(spark, sf_dir):
    """A table function in SQL over partitions: the distinct indicators of each document."""
    from palisade.functions.tables import register

    register(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return spark.sql("SELECT * FROM table_indicators(TABLE(SELECT doc_id, lang, text FROM {docs}) PARTITION BY (doc_id, lang), 'text')", docs=docs)


@query("""SELECT counter, n FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE value > 10) AS large, count(*) FILTER (WHERE props IS NULL) AS empty FROM events) UNPIVOT (n FOR counter IN (n_rows, large, empty))""")
def stream_metrics(spark, sf_dir):
    """Counters of a stream's rules, taken while it runs, from the log that its listener writes."""
    from palisade.operators import metrics

    at = scratch.new_folder(spark, "metrics")
    listener = metrics.MetricsLog(f"{at}/log")
    spark.streams.addListener(listener)
    try:
        seen = metrics.observed_stream(_event_stream(spark, sf_dir), "events", large=F.col("value") > 10, empty=F.col("props").isNull())
        q = seen.writeStream.format("noop").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        metrics.wait_for_log(spark, f"{at}/log", str(q.id), q.lastProgress.batchId if q.lastProgress else -1)
    finally:
        spark.streams.removeListener(listener)
    return metrics.read_log(spark, f"{at}/log").groupBy("counter").agg(F.sum("n").alias("n"))


@query("""SELECT 'https://img.example.test/' || p_partkey || '/' || substr(p_brand, 7) || '/' || p_size AS image_url,
  CASE WHEN p_partkey % 11 = 0 THEN 'failed' WHEN p_size < 10 THEN 'too small' END AS skipped,
  CASE WHEN p_partkey % 11 = 0 OR p_size < 10 THEN '' ELSE 'The beacon of brand ' || substr(p_brand, 7) || ' reaches its server every hour' END AS text FROM part""")
def image_memo(spark, sf_dir):
    """Images of parts, read in two runs with a memo: the second fetches what is new and what failed, and recognises no bytes twice."""
    import numpy as np

    from palisade.operators.images import read_remembered

    def fetch(url: str) -> tuple[int, str, bytes]:
        key, brand, size = url.split("/")[-3:]
        return (500 if int(key) % 11 == 0 else 200), "image/png", f"{brand} {size}".encode()

    def decode(content: bytes) -> np.ndarray:
        brand, size = content.decode().split()
        return np.full((300, 150 if int(size) < 10 else 600, 1), int(brand), np.uint8)

    say = lambda pixels: f"The beacon of brand {int(pixels.flat[0])} reaches its server every hour"
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)
    images = table(spark, sf_dir, "part").select(F.concat_ws("/", F.lit("https://img.example.test"), F.col("p_partkey").cast("string"), number, F.col("p_size").cast("string")).alias("image_url"), "p_partkey")
    memo = f"{scratch.new_folder(spark, 'memo')}/images"
    read_remembered(images.where("p_partkey % 2 = 0"), memo, fetch, say, decode, lambda x: x)
    again = read_remembered(images, memo, fetch, say, decode, lambda x: x)
    return again.select("image_url", F.regexp_extract("skipped", r"^([^(]*[^( ])", 1).alias("skipped"), "text")
