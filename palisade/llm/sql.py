"""DuckDB SQL for the queries that SQL can express, over the views documents, benchmark and labels."""

LOWER_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT item_id, least(len(ws), 10) AS m, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS i, ws FROM b WHERE len(ws) > 0
), win AS (
  SELECT DISTINCT item_id, m, array_to_string(ws[i : i + m - 1], ' ') AS win FROM bw
), sizes AS (SELECT DISTINCT m FROM win
), dw AS (
  SELECT r, m, unnest(generate_series(1, len(ws) - m + 1)) AS i, ws FROM w, sizes WHERE len(ws) >= m
), hits AS (
  SELECT r, i, dw.m, item_id FROM (SELECT r, m, i, array_to_string(ws[i : i + m - 1], ' ') AS win FROM dw) dw JOIN win USING (m, win)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i FROM d),
k AS (SELECT *, {LOWER_AZ.format(f"trim(line, {SPACES})")} AS key FROM l),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(common.key) FILTER (WHERE k.doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.key IS NULL OR k.doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN common USING (key) GROUP BY k.doc_id, k.r
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), tri AS (
  SELECT r, unnest(list_transform(generate_series(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS w, unnest(generate_series(1, len(ws) - 2)) AS i
  FROM d WHERE len(ws) > 2
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM tri) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS x FROM f WHERE source IS NOT NULL GROUP BY source
), s AS (SELECT sum(n) AS sn, sum(x) AS sx, sum(n * n) AS snn, sum(x * x / n) AS sxx, count(*) AS hosts FROM h
), p AS (
  SELECT sx / sn AS mean, 1 / least(greatest(coalesce(
    ((sxx - sn * (sx / sn) * (sx / sn)) - (sx / sn) * (1 - sx / sn) * (hosts - 1)) / nullif((sx / sn) * (1 - sx / sn) * (sn - snn / sn - (hosts - 1)), 0), 0), 1e-6), 0.5) - 1 AS strength FROM s
), v AS (SELECT source, (x + mean * strength) / (n + strength) <= 0.5 AS host_kept FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(host_kept, true) AS kept FROM f LEFT JOIN v USING (source)
"""

OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), sets AS (
  SELECT doc_id, r, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(ws) - 3), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS sh FROM d
), e AS (SELECT r, unnest(sh) AS s FROM sets
), shared AS (SELECT s FROM e GROUP BY s HAVING count(*) > 1
), q AS (SELECT r, s FROM e JOIN shared USING (s)
), pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM q a JOIN q b USING (s) WHERE a.r < b.r GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sets a ON x = a.r JOIN sets b ON y = b.r WHERE 100 * c >= 85 * (len(a.sh) + len(b.sh) - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (SELECT r, r AS z FROM sets UNION SELECT reach.r, y FROM reach JOIN both_ways ON z = x)
SELECT sets.doc_id, CAST(len(sets.sh) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT reach.r, min(t.doc_id) AS component_id FROM reach JOIN sets t ON z = t.r GROUP BY reach.r) c USING (r)
"""

#: crc32 of ASCII texts: its table, a list of 256, and the value of {0} with that table as column crc.
CRC_TABLE = """SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc FROM range(256) t(n)"""
CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"))) + ")"


OP11 = rf"""
WITH RECURSIVE crcs AS ({CRC_TABLE}), d AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("(CAST(n_chars AS HUGEINT) + 1)")} AS more, coalesce({CRC32.format("CAST(doc_id AS VARCHAR)")} % 7 = 0, false) AS tamper FROM documents, crcs)
), node AS (
  SELECT CAST(0 AS BIGINT) AS l, lang, pos, n, leaf AS h FROM d
  UNION ALL
  SELECT l + 1, lang, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY l, lang, pos // 2
), tops AS (
  SELECT lang, l AS depth, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
), upper AS (
  SELECT CAST(0 AS BIGINT) AS l, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT l + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY l, pos // 2
), root AS (SELECT h AS root, l AS height FROM upper WHERE n = 1
), spot AS (
  SELECT row_number() OVER () AS r, d.*, tops.depth, tops.subroot, tops.pos AS place, root, height FROM d JOIN tops ON d.lang IS NOT DISTINCT FROM tops.lang, root
), step AS (
  SELECT r, i, (spot.pos >> i) & 1 AS is_right, node.h AS sibling
  FROM (SELECT *, unnest(range(depth)) AS i FROM spot) spot LEFT JOIN node ON node.l = i AND node.lang IS NOT DISTINCT FROM spot.lang AND node.pos = xor(spot.pos >> i, 1)
  UNION ALL
  SELECT r, depth + i, (spot.place >> i) & 1, upper.h FROM (SELECT *, unnest(range(height)) AS i FROM spot) spot LEFT JOIN upper ON upper.l = i AND upper.pos = xor(spot.place >> i, 1)
), fold AS (
  SELECT r, CAST(0 AS BIGINT) AS i, CASE WHEN tamper THEN more ELSE leaf END AS h FROM spot
  UNION ALL
  SELECT fold.r, fold.i + 1, sha256(CASE WHEN is_right = 1 THEN coalesce(sibling, '') || h ELSE h || coalesce(sibling, '') END) FROM fold JOIN step ON fold.r = step.r AND fold.i = step.i
), proof AS (SELECT r, sha256(coalesce(string_agg(sibling, '' ORDER BY i), '')) AS proof_sha256 FROM step GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
FROM spot JOIN fold ON fold.r = spot.r AND fold.i = depth + height LEFT JOIN proof ON proof.r = spot.r
"""

#: A state of op13's SQL is a text: ten digits of cost, then the audit; {1} is added to the first, {2} to the second.
_STEP = "(lpad(CAST(CAST(left({0}, 10) AS BIGINT) + {1} AS VARCHAR), 10, '0') || substr({0}, 11) || '{2}')"


def _step(state: str, cost: str, letter: str) -> str:
    return _STEP.format(state, cost, letter)


def _may(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _inserted(states: tuple[str, str, str, str]) -> tuple[str, str, str, str]:
    """The states 0 to 3 (start, system, user, assistant) once one insertion is allowed."""
    a, b, c, d = states
    return a, b, f"least({c}, {_step(a, '3', 'I')}, {_step(b, '3', 'I')}, {_step(d, '3', 'I')})", f"least({d}, {_step(c, '3', 'I')})"


def _turned() -> tuple[str, str, str, str]:
    """The states after a turn: deleted, kept or given another role; x is the state before and t the turn."""
    gone = [_step(f"x.q{i}", "4", "D") for i in range(4)]
    keep = lambda i, role: _may(f"NOT must_go AND initial = '{role}'", _step(f"x.q{i}", "more", "K"))
    other = lambda i: _may("NOT must_go", _step(f"x.q{i}", "3 + more", "R"))
    to_user = ", ".join(f(i) for i in (0, 1, 3) for f in (lambda i: keep(i, "u"), other))
    return gone[0], f"least({gone[1]}, {keep(0, 's')})", f"least({gone[2]}, {to_user})", f"least({gone[3]}, {keep(2, 'a')}, {other(2)})"


def _select(states: tuple[str, ...]) -> str:
    return ", ".join(f"{s} AS q{i}" for i, s in enumerate(states))


_Q = tuple(f"q{i}" for i in range(4))

OP13 = rf"""
WITH RECURSIVE crcs AS ({CRC_TABLE}), c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm FROM conversations, crcs
), h AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE harm <> 0
), o AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    left(role, 1) AS initial, rtrim(text, {SPACES}) AS body FROM h
), p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS last FROM o
), t AS (
  SELECT *, body = '' OR again AS must_go, CASE WHEN NOT (body = '' OR again) AND right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS more FROM p
), zero AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, '0000000000' AS q0, CAST(NULL AS VARCHAR) AS q1, CAST(NULL AS VARCHAR) AS q2, CAST(NULL AS VARCHAR) AS q3 FROM t
), z AS (SELECT k, i, {_select(_inserted(_Q))} FROM (SELECT k, i, {_select(_inserted(_Q))} FROM zero)
), x AS (
  SELECT k, i, q0, q1, q2, q3 FROM z
  UNION ALL
  SELECT k, i, {_select(_inserted(_Q))} FROM (SELECT k, i, {_select(_inserted(_Q))} FROM (SELECT x.k, t.i, {_select(_turned())} FROM x JOIN t ON t.k = x.k AND t.i = x.i + 1))
), best AS (
  SELECT k, CAST(left(b, 10) AS BIGINT) AS cost, substr(b, 11) AS audit FROM (SELECT k, least(q0, q3) AS b FROM x QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1)
), letter AS (
  SELECT k, unnest(string_split(audit, '')) AS e, unnest(generate_series(1, length(audit))) AS j, (length(audit) - length(replace(audit, 'D', ''))) % 2 <> length(audit) % 2 AS system FROM best WHERE audit <> ''
), made AS (
  SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY j) AS i, sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY j) - CASE WHEN system THEN 1 ELSE 0 END AS place FROM letter
), repaired AS (
  SELECT made.k, sha256(string_agg(CASE WHEN e = 'K' THEN t.role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY j)) AS hash
  FROM made LEFT JOIN t ON t.k = made.k AND t.i = made.i WHERE e <> 'D' GROUP BY made.k
), facts AS (
  SELECT conv_id, k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE body = '') AS blank, count(*) FILTER (WHERE body <> '' AND again) AS duplicate,
    count(*) FILTER (WHERE more > 0) AS truncated, count(*) FILTER (WHERE last || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY conv_id, k
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN best USING (k) LEFT JOIN repaired USING (k)
"""

ORACLES = {"op3_decontamination": OP3, "op4_host_rules": OP4, "op6_line_dedup": OP6, "op8_jaccard_join": OP8, "op11_merkle": OP11, "op13_conversations": OP13}
