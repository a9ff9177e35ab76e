"""The same results in DuckDB SQL, for operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"coalesce({text}, '')")}, '{pattern}')"


SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_words("text", SPACED)} AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
f AS (SELECT e.* FROM e JOIN shared USING (g)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
  FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (n + m - c)),
r AS (
  SELECT a AS id, a AS other FROM l
  UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other
), m AS (SELECT id, min(other) AS c FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id
FROM s LEFT JOIN m ON m.id = s.doc_id
"""

LEAKS = f"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words("text", ALNUM)} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, {_words("text", ALNUM)} AS w FROM documents
), m AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)
), h AS (SELECT doc_id, m, i, item FROM dw JOIN bw USING (m, g)),
k AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(k.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.s, '')) AS items_sha256,
       coalesce(k.n, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _raked(rounds: int, powers: dict[str, float]) -> str:
    """The rounds of raking, one block per dimension and round."""
    blocks, last, k = [], "c0", 0
    for _ in range(rounds):
        for d in ("source", "lang", "topic"):
            k += 1
            blocks.append(f"""
c{k} AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, c.m, c.f * CASE WHEN s.s > 0 THEN t.t / s.s ELSE 1 END AS f
  FROM {last} c
  JOIN (SELECT {d} AS v, sum(m * f) AS s FROM {last} GROUP BY 1) s ON s.v IS NOT DISTINCT FROM c.{d}
  JOIN t_{d} t ON t.v IS NOT DISTINCT FROM c.{d}
)""")
            last = f"c{k}"
    targets = [
        f"""
p_{d} AS (SELECT {d} AS v, pow(CAST(sum(m) AS DOUBLE), {powers.get(d, 1.0)}) AS p FROM c0 GROUP BY 1),
t_{d} AS MATERIALIZED (
  SELECT v, p / (SELECT sum(p) FROM p_{d}) * (SELECT CAST(sum(m) AS DOUBLE) FROM c0) AS t FROM p_{d})"""
        for d in ("source", "lang", "topic")
    ]
    return ",".join([*targets, *blocks, f"""
raked AS (SELECT *, least(1, f / (SELECT max(f) FROM {last} WHERE m > 0)) AS p FROM {last})"""])


MIXED = f"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE
      WHEN text IS NULL OR text = '' THEN 'empty' WHEN contains(text, ' | ') THEN 'tables'
      WHEN contains(text, 'http') OR contains(text, '@') THEN 'links' WHEN contains(text, '?') THEN 'questions'
      WHEN regexp_matches(text, '[0-9]{{4}}') THEN 'figures' WHEN length(text) > 6000 THEN 'long' ELSE 'prose'
    END AS topic, CAST(len({_words("text", SPACED)}) AS BIGINT) AS n_tokens
  FROM documents
), c0 AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS m, CAST(1 AS DOUBLE) AS f FROM sized GROUP BY ALL
), {_raked(8, {"source": 0.85})}
SELECT doc_id, s.source, s.lang, s.topic, n_tokens, round(f, 6) AS factor, round(p, 6) AS probability,
       CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < p AS kept
FROM sized s JOIN raked r ON r.source IS NOT DISTINCT FROM s.source AND r.lang IS NOT DISTINCT FROM s.lang
  AND r.topic IS NOT DISTINCT FROM s.topic
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), g AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT DISTINCT a AS id, a AS other FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other
), c AS (SELECT id, min(other) AS c FROM r GROUP BY id), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.c, vec_id) AS component_id,
       coalesce(c.c, vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.id = vec_id
"""


def licensed(templates: dict[str, str], threshold: float) -> str:
    values = ", ".join(f"('{name}', '{text.replace("'", "''")}')" for name, text in sorted(templates.items()))
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    bound = threshold / (2 - threshold)
    return f"""
WITH t AS (
  SELECT name, {pairs} AS b, len(w) - 1 AS size, CAST(ceil({bound} * len(b) - 1e-9) AS BIGINT) AS need
  FROM (SELECT name, {_words("text", ALNUM)} AS w FROM (VALUES {values}) AS x(name, text))
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents
), s AS (
  SELECT doc_id, text FROM lines UNION ALL SELECT doc_id, text FROM documents
), c AS (
  SELECT doc_id, {pairs} AS b FROM (SELECT doc_id, {_words("text", ALNUM)} AS w FROM s) WHERE len(w) > 1
), m AS (
  SELECT doc_id, name, 2.0 * len(list_intersect(c.b, t.b)) / (len(c.b) + len(t.b)) AS dice FROM c JOIN t
    ON len(c.b) >= {bound} * len(t.b) AND len(c.b) <= len(t.b) / {bound}
), lw AS (
  SELECT doc_id, line, {_words("text", ALNUM)} AS ws FROM lines
), w AS (
  SELECT doc_id, line, word, row_number() OVER (PARTITION BY doc_id ORDER BY line, i) - 1 AS pos
  FROM (SELECT doc_id, line, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM lw)
), p AS MATERIALIZED (
  SELECT doc_id, pos, line, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS pair,
         count(*) OVER (PARTITION BY doc_id) - 1 AS n FROM w
), tp AS (
  SELECT name, size, need, len(b) AS own, unnest(b) AS pair FROM t
), hits AS (
  SELECT doc_id, name, pos, n, size, need, own, p.pair FROM p JOIN tp USING (pair) WHERE n >= size
), near AS (
  SELECT a.doc_id, a.name, a.n, a.size, a.own, a.pos AS first, b.pos AS last
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY pos) AS k FROM hits) a
  JOIN (SELECT doc_id, name, pos, row_number() OVER (PARTITION BY doc_id, name ORDER BY pos) AS k FROM hits) b
    ON a.doc_id = b.doc_id AND a.name = b.name AND b.k = a.k + a.need - 1 AND b.pos - a.pos < a.size
), starts AS (
  SELECT DISTINCT doc_id, name, size, own, unnest(range(greatest(last - size + 1, 0), least(first, n - size) + 1)) AS start FROM near
), d AS (
  SELECT s.doc_id, s.name, s.size, s.start,
         2.0 * count(DISTINCT p.pair) FILTER (tp.pair IS NOT NULL) / (count(DISTINCT p.pair) + any_value(s.own)) AS dice,
         max(p.line) FILTER (p.pos = s.start) AS line
  FROM starts s JOIN p ON p.doc_id = s.doc_id AND p.pos >= s.start AND p.pos < s.start + s.size
  LEFT JOIN tp ON tp.name = s.name AND tp.pair = p.pair GROUP BY ALL HAVING dice >= {threshold}
), place AS (
  SELECT *, sum(gap) OVER (PARTITION BY doc_id, name ORDER BY start) AS place FROM (
    SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id, name ORDER BY start) < size THEN 0 ELSE 1 END AS gap FROM d)
), best AS (
  SELECT doc_id, name, size, start, line, dice FROM place
  QUALIFY row_number() OVER (PARTITION BY doc_id, name, place ORDER BY dice DESC, start) = 1
), found AS (
  SELECT doc_id, name, dice FROM m WHERE dice >= {threshold}
  UNION ALL
  SELECT b.doc_id, b.name, b.dice FROM best b JOIN w ON w.doc_id = b.doc_id AND w.pos = b.start + b.size WHERE w.line > b.line
), g AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS best FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(names, '') AS licenses,
       round(CAST(best AS DOUBLE), 6) AS best_dice
FROM documents LEFT JOIN g USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit; NULL of NULL."""
    bits = "list_reduce(list_prepend({x}, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    each = bits.format(x="xor(s, b)")
    return f"CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {codes}), lambda s, b: {each}), 4294967295) AS BIGINT)"


def _runs(longest: int) -> str:
    """Runs of periods up to ``longest``, a power of two.

    In a run of period q the k words from its first one on, k the least power of two from q,
    return exactly q later: distances between equal neighbours propose all periods.
    """
    blocks, parts, k, j = ["g0 AS MATERIALIZED (SELECT rid, i, hash(w) AS h FROM t)"], [], 1, 0
    while True:
        parts.append(f"""
  SELECT DISTINCT rid, d FROM (
    SELECT rid, lead(i) OVER (PARTITION BY rid, h ORDER BY i) - i AS d FROM g{j}) WHERE 2 * d > {k} AND d <= {k}""")
        if k >= longest:
            break
        blocks.append(f"""g{j + 1} AS MATERIALIZED (
  SELECT rid, i, hash(h, l) AS h FROM (
    SELECT rid, i, h, lead(h, {k}) OVER (PARTITION BY rid ORDER BY i) AS l FROM g{j}) WHERE l IS NOT NULL)""")
        k, j = 2 * k, j + 1
    return ",\n".join(blocks) + ",\nc AS MATERIALIZED (" + " UNION ALL".join(parts) + ")"


RUNS = f"""
WITH x AS (
  SELECT row_number() OVER () AS rid, doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h,
         regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents
), y AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM x
), z AS (
  SELECT *, g % nullif(n, 0) AS a, 1 + (n - g % nullif(n, 0)) // (3 + g % 8) AS p FROM y
), d AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(
    range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM z
), t AS MATERIALIZED (
  SELECT rid, unnest(w) AS w, unnest(range(len(w))) AS i FROM d
), {_runs(8192)}, e AS (
  SELECT c.rid, c.d, a.i, a.i - row_number() OVER (PARTITION BY c.rid, c.d ORDER BY a.i) AS island
  FROM c JOIN t a USING (rid) JOIN t b ON b.rid = c.rid AND b.i = a.i + c.d AND b.w = a.w
), r AS MATERIALIZED (
  SELECT rid, s, n, min(d) AS q FROM (
    SELECT rid, d, min(i) AS s, count(*) + d AS n FROM e GROUP BY rid, d, island)
  WHERE n >= greatest(6, 4 * d) GROUP BY rid, s, n
), m AS (
  SELECT rid, count(*) AS n_runs, max({{'n': n, 's': -s, 'q': -q}}) AS best,
         string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY rid
), k AS (
  SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept FROM t
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = t.rid AND t.i >= r.s + r.q AND t.i < r.s + r.n) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(-best.s AS BIGINT) AS start,
       CAST(best.n AS BIGINT) AS length, CAST(-best.q AS BIGINT) AS period,
       CAST(1000 * best.n // -best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN m USING (rid) LEFT JOIN k USING (rid)
"""


def _structure() -> str:
    """Cheapest edits by a forward walk over turns: per state (cost k, initials a, text r).

    Of equal costs at one state neither list of initials begins the other, so the least
    list so far stays the least.
    """
    never = 1_000_000_000

    def made(v: str, cost: str, initial: str, line: str | None) -> str:
        text = f"{v}.r" if line is None else f"{v}.r || chr(10) || {line}"
        return f"{{'k': CAST({v}.k + {cost} AS BIGINT), 'a': {v}.a || '{initial}', 'r': {text}}}"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    given = lambda role: f"'{role}:'"
    insert = lambda v, role: made(v, "5", "I", given(role))
    own = "role || ':' || text"
    keep = lambda v, x: made(v, f"stay + CASE WHEN who = '{x}' THEN 0 ELSE {never} END", "K", own)
    name = lambda v, role: made(v, "stay + 1", "R", f"'{role}:' || text")
    drop = lambda v: made(v, "2", "D", None)
    opened = least("v2", *(insert(v, "user") for v in ("v0", "v1", "v3")))
    closed = least("v3", insert("w2", "assistant"))
    none = f"{{'k': CAST({never} AS BIGINT), 'a': '', 'r': ''}}"
    before_user = ("v0", "v1", "w3")
    return f"""
WITH RECURSIVE o AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h
  FROM conversations
), r AS MATERIALIZED (
  SELECT c, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM o
), p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role,
              sha256(length(role) || ':' || role || text), copy) AS i FROM r
), f AS MATERIALIZED (
  SELECT c, i, turn, role, text, left(role, 1) AS who, CASE
      WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), FALSE) AS wrong
  FROM p
), g AS MATERIALIZED (
  SELECT *, CASE fault WHEN 'blank' THEN {never} WHEN 'duplicate' THEN {never} WHEN 'truncated' THEN 5 ELSE 0 END AS stay FROM f
), d AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, {{'k': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS v0, {none} AS v1, {none} AS v2, {none} AS v3 FROM p
  UNION ALL
  SELECT c, i, {drop("v0")}, {least(drop("v1"), keep("v0", "s"))},
         {least(drop("w2"), *(keep(v, "u") for v in before_user), *(name(v, "user") for v in before_user))},
         {least(drop("w3"), keep("w2", "a"), name("w2", "assistant"))}
  FROM (SELECT *, {closed} AS w3 FROM (
    SELECT d.c, g.i, v0, v1, v3, {opened} AS w2, role, text, who, stay FROM d JOIN g ON g.c = d.c AND g.i = d.i + 1))
), e AS (
  SELECT c, {least("v0", "w3")} AS best FROM (SELECT *, {closed} AS w3 FROM (
    SELECT d.c, v0, v1, v3, {opened} AS w2 FROM d JOIN (SELECT c, max(i) AS i FROM p GROUP BY c) USING (c, i)))
), s AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE wrong) AS illegal FROM f GROUP BY c
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.k, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM o) LEFT JOIN s USING (c) LEFT JOIN e USING (c)
"""


STRUCTURE = _structure()
