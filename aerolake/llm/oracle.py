"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
ALPHANUMERIC = r"regexp_extract_all(" + LOWER_AZ.format("coalesce({}, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH b AS (SELECT item_id, {ALPHANUMERIC.format('text')} AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS l, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
d AS (SELECT doc_id, {ALPHANUMERIC.format('text')} AS w FROM documents),
sizes AS (SELECT DISTINCT l FROM phrase),
win AS (
  SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS s
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, sizes WHERE len(w) >= l)
),
found AS (SELECT DISTINCT doc_id, item_id, i, l FROM win JOIN phrase USING (l, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

HOST_RULES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format('text')} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY doc_id),
line AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
base AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(line.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
  FROM d LEFT JOIN line USING (doc_id) LEFT JOIN rep USING (doc_id)
),
host AS (SELECT source, count(*) AS n, CAST(sum(CAST(base_failed AS INT)) AS BIGINT) AS failed FROM base GROUP BY source),
moments AS (SELECT sum(failed) / sum(n) AS m, var_pop(failed / n) AS v FROM host),
prior AS (SELECT m, CASE WHEN v * 1001 <= m * (1 - m) THEN 1000.0 ELSE greatest(1.0, m * (1 - m) / v - 1) END AS strength FROM moments),
bad AS (SELECT source, (failed + strength * m) / (n + strength) > 0.5 AS host_failed FROM host, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM base JOIN bad ON base.source IS NOT DISTINCT FROM bad.source
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS s FROM d),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
first AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (h) WHERE first_id < doc_id),
kept AS (SELECT doc_id, count(*) AS n, string_agg(s, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# turns as text lists; a conversation goes if its list begins another, longer list, or if
# an equal one has a smaller id
CHAT_SNAPSHOTS = """
WITH t AS (
  SELECT conv_id, turn, role, text, floor(turn / 64) AS segment,
         coalesce('=' || role, '-') || chr(1) || coalesce('=' || text, '-') || chr(2) AS said
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
),
p AS (
  SELECT conv_id, row_number() OVER w AS n, string_agg(said, '') OVER w AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING)
),
last AS (SELECT conv_id, n, prefix FROM p QUALIFY n = max(n) OVER (PARTITION BY conv_id)),
proper AS (SELECT DISTINCT p.n, p.prefix FROM p JOIN last USING (conv_id) WHERE p.n < last.n),
kept AS (
  SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_equal
  FROM last ANTI JOIN proper ON last.n = proper.n AND last.prefix = proper.prefix GROUP BY n, prefix
)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, n_turns, n_equal,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
FROM kept JOIN t USING (conv_id) GROUP BY conv_id, segment, n_turns, n_equal
"""


COLLOCATIONS = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_AZ.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS s FROM documents
),
said AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM said GROUP BY lang),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM said, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)
  GROUP BY ALL
),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE k >= 2 AND f >= 30),
cut AS (SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT cut.lang, cut.phrase, a, c, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
  FROM cut JOIN gram l ON l.lang = cut.lang AND l.phrase = first JOIN gram r ON r.lang = cut.lang AND r.phrase = rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_phrase AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))
),
dropped AS (SELECT DISTINCT lang, phrase FROM inner_phrase JOIN cand USING (lang, phrase) WHERE 100 * CAST(longer AS HUGEINT) >= 80 * CAST(a AS HUGEINT))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest ANTI JOIN dropped USING (lang, phrase) JOIN total USING (lang) QUALIFY rank <= 2000
"""

# a node is a hash of its turns; its totals are summed over all pairs of a node and one below it
CONVERSATION_TRIE = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM (SELECT DISTINCT c FROM t)
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN y % 2 = 1 THEN xor(y >> 1, CAST(3988292384 AS BIGINT)) ELSE y >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(s[i // 8 + 1]) AS BIGINT)) ELSE v END AS y FROM crc WHERE i < 8 * length(s))
),
h AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = 8 * length(s)),
head AS (SELECT h.c, t.p AS d, r, x FROM h JOIN t ON t.c = h.c - h.c % 5 AND t.p <= h.h),
taken AS (SELECT h.c, h.h, coalesce(max(d), 0) AS n FROM h LEFT JOIN head USING (c) GROUP BY ALL),
rebuilt AS (SELECT * FROM head UNION ALL SELECT c, p - h + n, r, x FROM t JOIN taken USING (c) WHERE p > h),
path AS (
  SELECT c, d, strlen(x) AS b, sha256(string_agg(strlen(r) || ':' || r || strlen(x) || ':' || x, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM h
),
node AS (SELECT d, node, min(c) AS c, count(*) AS n_convs, max(b) AS b FROM path GROUP BY d, node),
parent AS (SELECT n.d, n.node, p.node AS up FROM node n JOIN path p ON p.c = n.c AND p.d = n.d - 1),
kids AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM parent GROUP BY ALL),
below AS (
  SELECT p.d, p.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.b) AS BIGINT) AS saved_tokens
  FROM node n JOIN path p ON p.c = n.c AND p.d <= n.d LEFT JOIN kids ON kids.d = n.d AND kids.node = n.node GROUP BY ALL
),
ended AS (SELECT d, node, string_agg(c, ',' ORDER BY c) AS ids FROM (SELECT * FROM path QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY ALL)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, up.c AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node n LEFT JOIN parent ON parent.d = n.d AND parent.node = n.node LEFT JOIN node up ON up.d = n.d - 1 AND up.node = parent.up
LEFT JOIN kids ON kids.d = n.d AND kids.node = n.node JOIN below ON below.d = n.d AND below.node = n.node
LEFT JOIN ended ON ended.d = n.d AND ended.node = n.node
"""


def oracle_queries() -> dict[str, str]:
    return {
        "op1_decontaminate": DECONTAMINATE,
        "op3_host_rules": HOST_RULES,
        "op6_substring_dedup": SUBSTRING_DEDUP,
        "op7_chat_snapshots": CHAT_SNAPSHOTS,
        "op11_collocations": COLLOCATIONS,
        "op13_conversation_trie": CONVERSATION_TRIE,
    }
