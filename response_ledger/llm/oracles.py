"""DuckDB SQL with the same answers as the registered queries that SQL can express."""

from __future__ import annotations

from response_ledger.llm import fair_mix, host_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = f"""
WITH sized AS (
    SELECT doc_id, source, len({_WORDS}) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [{", ".join(map(str, fair_mix.WEIGHTS))}][1 + place % {len(fair_mix.WEIGHTS)}] AS weight,
        {fair_mix.PASSES} * source_size AS most,
        CAST(sum(source_size) OVER () AS DOUBLE) * {fair_mix.SHARE} AS budget
    FROM sources
), levels AS (
    SELECT *, most / weight AS full_at, (budget - CAST(coalesce(sum(most) OVER (
            ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
        / CAST(sum(weight) OVER (
            ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, place, budget, least(CAST(most AS DOUBLE),
        weight * (SELECT level FROM levels WHERE full_at >= level ORDER BY full_at, place LIMIT 1)) AS target
    FROM levels
), queued AS (
    SELECT row_number() OVER () AS id, s.doc_id, s.size, t.*, CAST(sum(s.size) OVER (
        PARTITION BY t.place ORDER BY s.key, s.size ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS done
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), events AS (
    SELECT id, size, place, budget, (done + CAST(source_size AS DOUBLE) * nth) / target AS finish
    FROM queued, range({fair_mix.PASSES}) n(nth) WHERE size > 0 AND target > 0
), taken AS (
    SELECT id, sum(size) AS taken FROM (
        SELECT *, sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS used FROM events
    ) WHERE used <= budget GROUP BY id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (id)
"""

MEASURED = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda one: regexp_matches(one, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
    FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
), repeated AS (
    SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, three) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT id, count(DISTINCT i + k) AS n FROM repeated, range(3) r(k) GROUP BY id
), measured AS (
    SELECT id, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN covered USING (id)
), judged AS (
    SELECT *, n_words < {host_rules.MIN_WORDS}
        OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM measured
), hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (base_failed
        OR 100 * n_symbols > {host_rules.MAX_SYMBOL_PERCENT} * word_chars
        OR 100 * n_dup_lines > {host_rules.MAX_DUP_LINE_PERCENT} * n_lines) AS k
    FROM judged GROUP BY source
), moments AS (
    SELECT sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 AS spread FROM hosts
), prior AS (
    SELECT mean, CASE WHEN spread > 0 THEN least({host_rules.PRIOR_DOCUMENTS[1]},
        greatest({host_rules.PRIOR_DOCUMENTS[0]}, mean * (1 - mean) / spread - 1))
        ELSE {host_rules.PRIOR_DOCUMENTS[1]} END AS weight
    FROM moments
), verdicts AS (
    SELECT source, (k + mean * weight) / (n + weight) AS host_rate FROM hosts, prior
)
"""

OP9 = f"""{MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
    NOT base_failed AND host_rate <= {host_rules.MAX_HOST_RATE} AS kept
FROM judged JOIN verdicts v ON judged.source IS NOT DISTINCT FROM v.source
"""

OP8 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs p JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * p.n >= 85 * (a.n + b.n - p.n)
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
    SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reached r JOIN ways w ON r.y = w.x
), groups AS (
    SELECT x, least(x, min(y)) AS component FROM reached GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
    coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN groups ON x = doc_id
"""

ORACLES = {"op7_fair_mix": OP7, "op8_near_duplicates": OP8, "op9_host_rules": OP9}
