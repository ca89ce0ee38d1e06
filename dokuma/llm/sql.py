"""SQL for the problem queries that SQL can express in reasonable time; the others are tested against brute force."""

from __future__ import annotations

from .queries import PERCENTILES


def low(c: str) -> str:
    return f"lower(replace(replace(nfc_normalize({c}), 'I', 'ı'), 'İ', 'i'))"


def words(c: str) -> str:
    return rf"regexp_extract_all({low(c)}, '[\p{{L}}\p{{N}}]+')"


def channel(c: str = "channel") -> str:
    return rf"trim(regexp_replace({low(c)}, '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"


def number(j: str) -> str:
    """A finite number of a JSON value (number, or text with point or comma), else NULL."""
    n = f"TRY_CAST(replace(trim({j}), ',', '.') AS DOUBLE)"
    return f"CASE WHEN isfinite({n}) THEN {n} END"


ONCE = "SELECT DISTINCT ON (id) * FROM clips WHERE id IS NOT NULL"

# Distinct features (word, occurrence) of each eligible text, then shared features by pair.
def bag_pairs(texts: str, sides: str) -> str:
    return f"""WITH texts AS ({texts}),
    w AS (SELECT id, side, unnest({words("t")}) AS word FROM texts),
    f AS (SELECT id, side, word, row_number() OVER (PARTITION BY id, side, word) AS nth FROM w),
    n AS (SELECT id, count(*) AS n FROM (SELECT DISTINCT id, word, nth FROM f) GROUP BY id HAVING count(*) >= 12),
    g AS (SELECT DISTINCT f.*, n.n FROM f JOIN n USING (id)),
    p AS (SELECT a.id AS ia, b.id AS ib, a.n AS na, b.n AS nb, count(*) AS shared FROM g a JOIN g b ON a.word = b.word AND a.nth = b.nth AND {sides} AND 10 * a.n >= 7 * b.n AND 10 * b.n >= 7 * a.n GROUP BY ALL)
    SELECT DISTINCT least(ia, ib) AS id_a, greatest(ia, ib) AS id_b FROM p WHERE 10 * shared >= 7 * (na + nb - shared)"""


P1 = bag_pairs(rf"SELECT id, 'x' AS side, CASE WHEN regexp_matches(text_spoken, '[^\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]') THEN text_spoken ELSE text END AS t FROM ({ONCE})", "a.id < b.id")
P3 = bag_pairs(
    f"SELECT c.id, CASE WHEN s.split = 'train' THEN 'b' ELSE 'a' END AS side, c.text AS t FROM ({ONCE}) c JOIN (SELECT DISTINCT id, lower(trim(split)) AS split FROM clip_splits) s ON s.id = c.id WHERE s.split IN ('train', 'dev', 'test')",
    "a.side = 'a' AND b.side = 'b' AND a.id <> b.id",
)
P3_WEIGHTED = f"""WITH t AS (SELECT c.id, s.split, c.text AS t FROM ({ONCE}) c JOIN (SELECT DISTINCT id, lower(trim(split)) AS split FROM clip_splits) s ON s.id = c.id WHERE s.split IN ('train', 'dev', 'test')),
    w AS (SELECT id, split, unnest({words("t")}) AS word FROM t),
    f AS (SELECT id, split, word, row_number() OVER (PARTITION BY id, split, word) AS nth, count(*) OVER (PARTITION BY id, split) AS n FROM w QUALIFY n >= 12),
    d AS (SELECT word, nth, ln(1 + (SELECT count(*) FROM (SELECT DISTINCT id, split FROM f)) / count(*)) AS x FROM f GROUP BY ALL),
    u AS (SELECT id, split, word, nth, x / sqrt(sum(x * x) OVER (PARTITION BY id, split)) AS x FROM f JOIN d USING (word, nth))
    SELECT DISTINCT a.id AS held_id, b.id AS train_id, round(sum(a.x * b.x), 6) AS cosine FROM u a JOIN u b ON a.word = b.word AND a.nth = b.nth AND a.split <> 'train' AND b.split = 'train' AND a.id <> b.id GROUP BY a.id, a.split, b.id HAVING sum(a.x * b.x) >= 0.8 - 1e-9"""
P2 = f"""WITH c AS (SELECT id, {channel()} AS ch, duration, CASE WHEN json_valid(metrics_json) THEN {number("metrics_json ->> '$.dnsmos_ovrl'")} END AS score FROM ({ONCE}) WHERE channel IS NOT NULL)
    SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY ch ORDER BY score DESC NULLS LAST, duration DESC NULLS LAST, id) AS r, count(*) OVER () AS n FROM c) WHERE r > n // 20"""
# Strata whose quota exceeds their size are filled first, in as many rounds as there are strata; then largest remainders.
_ROUND = lambda k: f"""r{k} AS (SELECT *, unfilled AND spare * weight > size * sum(weight) FILTER (unfilled) OVER o AS fills FROM s{k} WINDOW o AS (PARTITION BY ch)),
    s{k + 1} AS (SELECT ch, band, size, weight, unfilled AND NOT fills AS unfilled, spare - coalesce(sum(size) FILTER (fills) OVER o, 0) AS spare FROM r{k} WINDOW o AS (PARTITION BY ch)),"""  # noqa: E731
P2_STRATA = f"""WITH c AS (SELECT id, {channel()} AS ch, duration, CASE WHEN duration < 4 THEN 'short' WHEN duration < 9 THEN 'middle' WHEN duration >= 9 THEN 'long' END AS band, CASE WHEN json_valid(metrics_json) THEN {number("metrics_json ->> '$.dnsmos_ovrl'")} END AS score FROM ({ONCE}) WHERE channel IS NOT NULL),
    w AS (SELECT band, count(*) AS weight FROM c GROUP BY band),
    z AS (SELECT c.ch, c.band, count(*) AS size, any_value(weight) AS weight FROM c JOIN w ON c.band IS NOT DISTINCT FROM w.band GROUP BY ALL),
    s1 AS (SELECT ch, band, size, weight, true AS unfilled, (SELECT count(*) // 20 FROM c) AS spare FROM z QUALIFY sum(size) OVER (PARTITION BY ch) > (SELECT count(*) // 20 FROM c)),
    {"".join(map(_ROUND, range(1, 5)))}
    q AS (SELECT *, spare * weight // sum(weight) OVER o AS base, spare * weight % sum(weight) OVER o AS rem FROM s5 WHERE unfilled WINDOW o AS (PARTITION BY ch)),
    e AS (SELECT *, spare - sum(base) OVER (PARTITION BY ch) AS extra, row_number() OVER (PARTITION BY ch ORDER BY rem DESC, weight DESC, band NULLS FIRST) AS k FROM q),
    f AS (SELECT ch, band, base + (k <= extra)::INT AS slots FROM e UNION ALL SELECT ch, band, size FROM s5 WHERE NOT unfilled),
    o AS (SELECT id, ch, band, row_number() OVER (PARTITION BY ch, band ORDER BY score DESC NULLS LAST, duration DESC NULLS LAST, id) AS r FROM c)
    SELECT id, o.ch AS channel, o.band FROM o JOIN f ON o.ch = f.ch AND o.band IS NOT DISTINCT FROM f.band WHERE r > slots"""
P4 = f"""WITH l AS (SELECT id, {channel()} AS ch, source_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM ({ONCE}) WHERE channel IS NOT NULL AND text IS NOT NULL),
    k AS (SELECT id, ch, source_id, CAST(line_no AS INTEGER) AS line_no, {words("line")} AS ws FROM l),
    m AS (SELECT id, ch, source_id, line_no, regexp_replace(array_to_string(ws, ' '), '\\p{{Nd}}+', '0', 'g') AS key FROM k WHERE len(ws) >= 4)
    SELECT DISTINCT id, line_no FROM m WHERE (ch, key) IN (SELECT (ch, key) FROM m WHERE source_id IS NOT NULL GROUP BY ch, key HAVING count(DISTINCT source_id) >= 5)""".replace("\\\\", "\\")
# Repeated lines as a graph: nodes, edges of consecutive lines, reachable nodes, blocks with a long line, and their places in rows.
BLOCKS = rf"""WITH RECURSIVE l AS (SELECT id, {channel()} AS ch, source_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM ({ONCE}) WHERE channel IS NOT NULL AND text IS NOT NULL),
    k AS (SELECT id, ch, source_id, line_no, {words("line")} AS ws FROM l),
    m AS (SELECT id, ch, source_id, CAST(line_no AS INTEGER) AS line_no, len(ws) >= 4 AS long, regexp_replace(array_to_string(ws, ' '), '\p{{Nd}}+', '0', 'g') AS key, row_number() OVER (PARTITION BY id ORDER BY line_no) AS nth FROM k WHERE len(ws) > 0),
    nodes AS (SELECT ch, key, long FROM m WHERE source_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT source_id) >= 5),
    occ AS (SELECT m.* FROM m JOIN nodes USING (ch, key)),
    nx AS (SELECT *, lead(key) OVER w AS next, lead(nth) OVER w AS next_nth FROM occ WINDOW w AS (PARTITION BY id ORDER BY line_no)),
    e AS (SELECT ch, key AS a, next AS b FROM nx WHERE next_nth = nth + 1 AND source_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT source_id) >= 5),
    s AS (SELECT ch, a, b FROM e UNION SELECT ch, b, a FROM e),
    r(ch, key, reach) AS (SELECT ch, key, key FROM nodes UNION SELECT r.ch, r.key, s.b FROM r JOIN s ON r.ch = s.ch AND r.reach = s.a),
    blk AS (SELECT ch, key, min(reach) AS block FROM r GROUP BY ch, key),
    ok AS (SELECT ch, block FROM blk JOIN nodes USING (ch, key) GROUP BY ch, block HAVING bool_or(long)),
    own AS (SELECT occ.*, block FROM occ JOIN blk USING (ch, key) JOIN ok USING (ch, block)),
    cut AS (SELECT *, coalesce(lag(block) OVER w <> block OR lag(nth) OVER w <> nth - 1, true) AS new FROM own WINDOW w AS (PARTITION BY id ORDER BY line_no)),
    run AS (SELECT *, sum(new::INT) OVER (PARTITION BY id ORDER BY line_no) AS run FROM cut),
    places AS (SELECT * FROM (SELECT *, bool_or(long) OVER (PARTITION BY id, run) AS whole FROM run) WHERE whole)""".replace("\\\\", "\\")
P4_BLOCKS = f"""{BLOCKS}, n AS (SELECT ch, block, count(*) AS n_lines, count(*) FILTER (long) AS n_long FROM blk JOIN nodes USING (ch, key) JOIN ok USING (ch, block) GROUP BY ch, block),
    p AS (SELECT ch, block, min(id) AS first_id, arg_min(line_no, (id, line_no)) AS first_line, count(*) AS n_places FROM places GROUP BY ch, block)
    SELECT ch AS channel, first_id, first_line, n_lines, n_long, n_places FROM n JOIN p USING (ch, block)"""
P4_CLEAN = f"""{BLOCKS}, gone AS (SELECT id, list(line_no) AS gone, CAST(count(*) AS INTEGER) AS n FROM places GROUP BY id)
    SELECT c.id, CASE WHEN n IS NULL THEN text ELSE coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)), '') END AS text_clean, coalesce(n, 0) AS n_removed FROM ({ONCE}) c LEFT JOIN gone USING (id)"""
P5 = f"""WITH RECURSIVE e AS (SELECT DISTINCT source_id AS s, {channel()} AS c FROM ({ONCE}) WHERE source_id IS NOT NULL AND channel IS NOT NULL),
    n AS (SELECT DISTINCT a.c AS a, b.c AS b FROM e a JOIN e b USING (s) WHERE a.c <> b.c),
    r(a, b) AS (SELECT a, b FROM n UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a)
    SELECT DISTINCT a AS channel_a, b AS channel_b FROM r WHERE a < b"""
P5_CHECKS = "SELECT fault, CAST(n_bad AS BIGINT) AS n_bad FROM (VALUES ('source in several splits', 0), ('channel in several splits', 0), ('split further from its share than two of the largest groups', 0)) v(fault, n_bad) UNION ALL SELECT 'none: clips in all', count(DISTINCT id) FROM clips"
P6 = f"""WITH c AS (SELECT {channel()} AS channel, duration, metrics_json AS m FROM ({ONCE}) WHERE channel IS NOT NULL),
    v AS (SELECT channel, 'duration' AS metric, duration AS x FROM c UNION ALL
      SELECT channel, k AS metric, {number("m ->> ('$.' || k)")} AS x FROM (SELECT channel, m, unnest(json_keys(m)) AS k FROM c WHERE json_valid(m) AND json_type(m) = 'OBJECT') WHERE k <> 'duration'),
    o AS (SELECT channel, metric, x, row_number() OVER w AS r, count(*) OVER (PARTITION BY channel, metric) AS n_values FROM v WHERE isfinite(x) WINDOW w AS (PARTITION BY channel, metric ORDER BY x)),
    p AS (SELECT unnest([{", ".join(f"{p}::DOUBLE" for p in PERCENTILES)}]) AS p)
    SELECT channel, metric, p, n_values, x + 0.0 AS value FROM o JOIN p ON r = greatest(1, CAST(ceil(p * n_values - 1e-9) AS BIGINT))"""
P6_BOUNDS = f"SELECT *, true AS inside, true AS near FROM ({P6})"
P7_CHECKS = "SELECT fault, CAST(n_bad AS BIGINT) AS n_bad FROM (VALUES ('container above its capacity', 0), ('container with a gap or an overlap', 0), ('text cut although it fits', 0), ('piece placed twice', 0), ('tokens lost or added', 0)) v(fault, n_bad) UNION ALL SELECT 'none: documents in all', count(DISTINCT doc_id) FROM documents"
FOLD = lambda c: rf"translate(lower(replace(replace(regexp_replace(nfc_normalize({c}), '[\x{{00ad}}\x{{200b}}-\x{{200d}}\x{{2060}}\x{{feff}}]', '', 'g'), 'I', 'ı'), 'İ', 'i')), 'çğıöşüâîû', 'cgiosuaiu')"
P8 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({FOLD("text")}, '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
    i AS (SELECT item_id, regexp_extract_all({FOLD("text")}, '[\p{{L}}\p{{N}}]+') AS w FROM eval_items WHERE text IS NOT NULL),
    g AS (SELECT item_id, least(len(w), 12) AS k, unnest([array_to_string(w[j : j + least(len(w), 12) - 1], ' ') for j in range(1, len(w) - least(len(w), 12) + 2)]) AS s FROM i WHERE len(w) > 0),
    ks AS (SELECT DISTINCT k FROM g),
    h AS (SELECT doc_id, k, unnest([array_to_string(w[j : j + k - 1], ' ') for j in range(1, len(w) - k + 2)]) AS s FROM d, ks WHERE len(w) >= k)
    SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (k, s)"""

# One edit: a word replaced (both with that place starred), missing from the document, or added to it.
P8_NEAR = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({FOLD("text")}, '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
    i AS (SELECT item_id, regexp_extract_all({FOLD("text")}, '[\p{{L}}\p{{N}}]+') AS w FROM eval_items WHERE text IS NOT NULL),
    p AS (SELECT item_id, least(len(w), 12) AS m, unnest([w[j : j + least(len(w), 12) - 1] for j in range(1, len(w) - least(len(w), 12) + 2)]) AS r FROM i WHERE len(w) > 0),
    ms AS (SELECT DISTINCT m FROM p), ks AS (SELECT m AS k FROM ms UNION SELECT m - 1 FROM ms WHERE m > 1 UNION SELECT m + 1 FROM ms WHERE m > 1),
    h AS (SELECT doc_id, k, unnest([w[j : j + k - 1] for j in range(1, len(w) - k + 2)]) AS r FROM d, ks WHERE len(w) >= k),
    pk AS (SELECT item_id, m, 0 AS kind, 0 AS j, r FROM p UNION ALL SELECT item_id, m, 1, j, r[1 : j - 1] || ['*'] || r[j + 1 :] FROM p, range(1, 13) t(j) WHERE m > 1 AND j <= m
      UNION ALL SELECT item_id, m, 2, 0, r[1 : j - 1] || r[j + 1 :] FROM p, range(1, 13) t(j) WHERE m > 1 AND j <= m UNION ALL SELECT item_id, m, 3, 0, r FROM p WHERE m > 1),
    hk AS (SELECT doc_id, k AS m, 0 AS kind, 0 AS j, r FROM h UNION ALL SELECT doc_id, k, 1, j, r[1 : j - 1] || ['*'] || r[j + 1 :] FROM h, range(1, 13) t(j) WHERE j <= k AND k IN (SELECT m FROM ms)
      UNION ALL SELECT doc_id, k + 1, 2, 0, r FROM h UNION ALL SELECT doc_id, k - 1, 3, 0, r[1 : j - 1] || r[j + 1 :] FROM h, range(2, 13) t(j) WHERE j < k)
    SELECT doc_id, item_id, CAST(min(least(kind, 1)) AS BIGINT) AS distance FROM (SELECT doc_id, m, kind, j, array_to_string(r, ' ') AS s FROM hk) JOIN (SELECT item_id, m, kind, j, array_to_string(r, ' ') AS s FROM pk) USING (m, kind, j, s) GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1, "p2_found": P2, "p2_strata": P2_STRATA, "p3_found": P3, "p3_weighted": P3_WEIGHTED, "p4_found": P4, "p4_blocks": P4_BLOCKS, "p4_clean": P4_CLEAN, "p5_found": P5, "p5_checks": P5_CHECKS, "p6_percentiles": P6, "p6_bounds": P6_BOUNDS, "p7_checks": P7_CHECKS, "p8_found": P8, "p8_near": P8_NEAR, "p8_items": f"SELECT item_id, count(*) AS n_documents FROM ({P8}) GROUP BY item_id"}
