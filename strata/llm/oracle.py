"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

# Five hex digits are four base-32 digits.
_B32 = "array_to_string([{v} for i in range(0, 8)], '')"
_GROUP = "CAST('0x' || substr(sha, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)"
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({g} >> {s}) & 31) + 1 AS INTEGER), 1)"
_BASE32 = _B32.format(v=" || ".join(_DIGIT.format(g=_GROUP, s=s) for s in (15, 10, 5, 0)))

OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS response FROM p)
SELECT page_id, strlen(html) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM r
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(t=_LOWER)

OP4 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, k, win FROM (SELECT item, least(len(w), 13) AS k, unnest(
  [array_to_string(w[i:i + least(len(w), 13) - 1], ' ') for i in range(1, len(w) - least(len(w), 13) + 2)]) AS win FROM b)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
  unnest([array_to_string(w[j:j + k - 1], ' ') for j in range(1, len(w) - k + 2)]) AS win FROM d, ks),
h AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

# Bits of the failed filters per document, counts per (part, bits), then every ordering's steps:
# the cells that reach a step are those that fail none of the filters before it.
_TEXT = "coalesce(text, '')"
_TOKENS = r"regexp_extract_all(" + _TEXT + r", '[^\x20\x09-\x0D]+')"
_FAILS = (
    "len(w) < 100",
    "100 * len(list_distinct(w)) < 80 * len(w)",
    r"100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t)",
    r"regexp_matches(t, '[#$%&*|]')",
    "coalesce(first_id < doc_id, first_id IS NOT NULL AND doc_id IS NULL)",
)
_MASK = " + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(_FAILS))

OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, {_TEXT} AS t, {_TOKENS} AS w,
  min(doc_id) OVER (PARTITION BY {_TEXT}) AS first_id FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT part, {_MASK} AS mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)),
o AS (SELECT a.name || b.name || g.name || h.name || e.name AS filter_order, [a.bit, b.bit, g.bit, h.bit, e.bit] AS bits
  FROM f a, f b, f g, f h, f e WHERE a.bit + b.bit + g.bit + h.bit + e.bit = 31 AND a.bit | b.bit | g.bit | h.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

# CRC-32 byte by byte over the distinct n-grams, its table made by the eight-step rule.
_STEP = "list_reduce(range(0, 9), lambda a, k: CASE WHEN k = 0 THEN a WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, CAST({x} AS BIGINT))"
_TABLE = "[" + _STEP.format(x="b") + " for b in range(0, 256)]"
_BYTES = "[CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT) for i in range(0, len(x) // 2)]"
_CRC = f"xor(list_reduce({_BYTES}, lambda c, y: xor(c >> 8, tab[CAST(xor(c, y) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
_PAIRS = "list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, greatest(len(w), 1))])"
_HASH = "CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
df AS (SELECT r, unnest({_PAIRS}) AS g FROM d),
bf AS (SELECT unnest({_PAIRS}) AS g FROM b),
tab AS (SELECT {_TABLE} AS tab),
h AS (SELECT g, {_CRC} % 10000 AS bucket FROM (SELECT g, hex(encode(g)) AS x FROM (SELECT g FROM df UNION SELECT g FROM bf)), tab),
s AS (SELECT bucket, count(*) AS s FROM df JOIN h USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN h USING (g) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM df) AS s_all, (SELECT count(*) FROM bf) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), n),
m AS (SELECT r, count(*) AS n_features, sum(gain) AS total FROM df JOIN h USING (g) JOIN gain USING (bucket) GROUP BY r),
e AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
  CAST(coalesce((total - (((total % n_features) + n_features) % n_features)) // n_features, 0) AS BIGINT) AS weight, {_HASH} AS h
  FROM d LEFT JOIN m USING (r)),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
  25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank, n_words FROM k
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_normaliser": OP2, "op4_suffix_decontamination": OP4, "op11_filter_audit": OP11,
            "op12_importance_resampling": OP12}
