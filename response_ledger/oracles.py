"""
For each registered query the same answer in plain SQL over the test tables. None of them
sees the ledgers, bodies or markup the queries work on.
"""

from __future__ import annotations

_BASE = "https://service.example/rest"

# A call attempt's fate, told from the event itself.
_ATTEMPTS = """
  SELECT *, CAST(props->>'$.k' AS INT) + 1 AS tries,
    CASE WHEN event_type IN ('signup', 'purchase')
           THEN CASE WHEN CAST(props->>'$.k' AS INT) + 1 >= 10 THEN 'exhausted' ELSE 'retriable' END
         WHEN event_type = 'view' THEN 'terminal'
         WHEN event_type = 'error' THEN 'api'
         WHEN value < 10 THEN 'malformed'
         WHEN value < 20 THEN 'undecodable'
         WHEN value < 30 THEN 'malformed'
         ELSE 'ok' END AS outcome
  FROM events
"""

_GOOD_BODY = (
    """'{"MESSAGE":"success","RESULTCOUNT":1,"STATUSCODE":400,"RESULT":{"COLUMNS":["VALUE"],"DATA":[["'"""
    """ || CAST(value AS VARCHAR) || '"]]}}'"""
)

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_STRIPPED = f"regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g')"

_BODY_PREFIX = (
    """payload={"displaycolumns":"productid,codeinformation","filter":"[{''centercd'':[''CBER'',''CDER'']}]","""
)

_HELD = """held AS (
          SELECT DISTINCT s + k AS i FROM total, (
            SELECT s, 100 AS size FROM total, range(1, n + 1, 100) t(s) WHERE s % 700 < 400
            UNION ALL SELECT s, 75 FROM total, range(1, n + 1, 75) t(s) WHERE s % 1050 > 800
            UNION ALL SELECT 1, 300
          ) pages, range(300) r(k) WHERE k < size AND s + k <= n)"""

ORACLES: dict[str, str] = {
    "page_plan": f"""
        SELECT '{_BASE}/recalls/' AS url, CAST(s AS INT) AS start, CAST(2500 AS INT) AS rows,
               'productid' AS sort, 'asc' AS sort_order
        FROM range(1, (SELECT count(*) + 1 FROM orders), 2500) t(s)""",
    "page_payloads": f"""
        SELECT CAST(s AS INT) AS start, 'POST' AS method,
               '{_BODY_PREFIX}"start":' || s
               || ',"rows":2500,"sort":"productid","sortorder":"asc"}}' AS body
        FROM range(1, (SELECT count(*) + 1 FROM orders), 2500) t(s)""",
    "page_members": """
        SELECT CAST(min(n) AS INT) AS start, count(*) AS records, min(o_orderkey) AS first_id,
               max(o_orderkey) AS last_id
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
        GROUP BY (n - 1) // 2500""",
    "workset_events": "SELECT DISTINCT o_custkey AS id FROM orders",
    "workset_products": "SELECT DISTINCT o_orderkey AS id FROM orders",
    "workset_kinds": """
        SELECT DISTINCT 'productid' AS id_column, o_orderkey AS id FROM orders
        UNION ALL SELECT DISTINCT 'recalleventid', o_custkey FROM orders""",
    "workset_size": """
        SELECT 'productid' AS id_column, count(DISTINCT o_orderkey) AS ids FROM orders
        UNION ALL SELECT 'recalleventid', count(DISTINCT o_custkey) FROM orders""",
    "remaining_events": """
        SELECT DISTINCT o_custkey AS id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer
                          WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
    "remaining_by_held_ids": """
        SELECT DISTINCT o_custkey AS id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer
                          WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
    "remaining_against_nothing": "SELECT DISTINCT o_custkey AS id FROM orders",
    "remaining_first": """
        SELECT DISTINCT o_custkey AS id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer
                          WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
        ORDER BY id LIMIT 100""",
    "batch_bounds": """
        SELECT (n - 1) // 1000 + 1 AS batch_no, count(*) AS ids, min(id) AS first_id, max(id) AS last_id
        FROM (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) AS n
              FROM (SELECT DISTINCT o_orderkey FROM orders))
        GROUP BY 1""",
    "id_requests": f"""
        SELECT 'EVENT' AS request_type, 'GET' AS method,
               '{_BASE}/recalls/event/' || o_custkey AS url, o_custkey AS path_id,
               'recalleventid,firmlegalnam' AS columns, true AS bare
        FROM (SELECT DISTINCT o_custkey FROM orders
              WHERE NOT EXISTS (SELECT 1 FROM customer
                                WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING'))""",
    "page_sizes": """
        SELECT o_orderkey, CAST(coalesce(
                 nullif(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN o_custkey END, 0),
                 CASE WHEN o_orderstatus = 'F' THEN 2500 ELSE 5000 END) AS INT) AS rows
        FROM orders""",
    "page_counts": """
        SELECT o_custkey, (count(*) + 2) // 3 AS pages FROM orders GROUP BY o_custkey""",
    "call_outcomes": f"""
        SELECT user_id AS batch_no, outcome, count(*) AS requests FROM ({_ATTEMPTS}) GROUP BY 1, 2""",
    "kept_responses": f"""
        SELECT 'EVENT' AS request_type, '{_BASE}/recalls/event/' || event_id AS url,
               event_id AS path_id, octet_length(encode(body)) AS content_length,
               sha256(body) AS sha_256, body AS content
        FROM (SELECT *, {_GOOD_BODY} AS body FROM ({_ATTEMPTS}) WHERE outcome = 'ok')""",
    "failed_calls": f"""
        SELECT event_id AS path_id, CAST(tries AS INT) AS attempts,
               CASE event_type WHEN 'signup' THEN '503' WHEN 'view' THEN '404'
                    WHEN 'purchase' THEN 'none' ELSE '200' END AS status,
               CASE outcome WHEN 'api' THEN '417' ELSE 'none' END AS api_status,
               outcome,
               CASE WHEN event_type = 'purchase' THEN 'transport: connection refused'
                    WHEN event_type = 'signup' THEN 'HTTP 503'
                    WHEN event_type = 'view' THEN 'HTTP 404'
                    WHEN event_type = 'error' THEN 'no such id (STATUSCODE 417)'
                    WHEN outcome = 'malformed' THEN 'body is not one JSON object'
                    ELSE 'body is not valid UTF-8' END AS failure
        FROM ({_ATTEMPTS}) WHERE outcome NOT IN ('ok', 'retriable')""",
    "retry_schedule": f"""
        SELECT event_id AS path_id, CAST(tries AS INT) AS attempts,
               least(greatest(1.0::DOUBLE * power(1.5::DOUBLE, tries), 1.0::DOUBLE), 30.0::DOUBLE) AS delay_seconds
        FROM ({_ATTEMPTS}) WHERE outcome = 'retriable'""",
    "attempt_totals": f"""
        SELECT count(*) FILTER (outcome = 'ok') AS written, count(*) FILTER (outcome <> 'ok') AS failed,
               count(DISTINCT user_id) AS batches,
               '{_BASE}/recalls/event/' || min_by(event_id, (user_id, event_id)) FILTER (outcome <> 'ok')
                 AS first_failed_url
        FROM ({_ATTEMPTS}) WHERE outcome <> 'retriable'""",
    "requeued_ids": f"SELECT event_id AS id FROM ({_ATTEMPTS}) WHERE outcome <> 'ok'",
    "body_digests": """
        SELECT doc_id, sha256(text) AS sha_256,
               CASE WHEN lang = 'en' THEN n_chars ELSE octet_length(encode(text)) END AS content_length
        FROM documents""",
    "undecodable_bodies": """
        SELECT lang, count(*) FILTER (lang IS DISTINCT FROM 'fr') AS decoded,
               count(*) FILTER (lang = 'fr') AS undecodable
        FROM documents GROUP BY lang""",
    "rejected_id_texts": """
        SELECT o_orderpriority AS id_text, count(*) AS records FROM orders
        WHERE o_orderstatus = 'P' GROUP BY 1""",
    "flattened_records": """
        SELECT o_orderkey AS productid, o_custkey AS recalleventid, o_orderstatus AS centercd,
               o_orderpriority AS productshortreasontxt, o_totalprice AS productdistributedquantity,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS recallinitiationdt
        FROM orders""",
    "flattened_tables": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'EVENT' WHEN 'MACHINERY' THEN 'EVENT'
                 WHEN 'AUTOMOBILE' THEN 'CODE_INFO' ELSE 'EVENT_PRODUCTS' END AS request_type,
               c_custkey AS recalleventid, c_name AS firmlegalnam, c_acctbal AS amount,
               'not in the body' AS phasetxt
        FROM customer""",
    "documented_types": """
        WITH counts AS (
          SELECT count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS undated,
                 count(*) FILTER (o_orderstatus = 'F') AS worded FROM orders)
        SELECT unnest(['productid', 'quantity', 'feinumber', 'recalleventid', 'recallinitiationdt', 'phasetxt'])
                 AS "column", unnest([n, n, n, n, n, 0]) AS "values",
               unnest(['bigint', 'double', 'string', 'string', 'string', 'string']) AS kind,
               CAST(0 AS BIGINT) AS misfits, CAST(0.0 AS DOUBLE) AS tolerance FROM counts
        UNION ALL
        SELECT unnest(['productid', 'quantity', 'feinumber', 'recalleventid', 'recallinitiationdt', 'phasetxt']),
               unnest([n, n, n, n, n, 0]),
               unnest(['bigint', 'double', 'string', 'string', 'date', 'string']),
               unnest([0, 0, 0, 0, undated, 0]), CAST(0.25 AS DOUBLE) FROM counts""",
    "typed_records": """
        SELECT o_orderkey AS productid,
               CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS quantity,
               lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS feinumber,
               CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE CAST(o_custkey AS VARCHAR) END AS recalleventid,
               CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
                 AS recallinitiationdt,
               'none' AS phasetxt,
               CASE WHEN o_orderpriority = '1-URGENT'
                 THEN '{"recallinitiationdt":"n/a ' || o_custkey || '"}' ELSE '' END AS rescued
        FROM orders""",
    "current_responses": """
        SELECT upper(event_type) AS request_type, user_id AS path_id,
               '{"event_id":' || event_id || ',"props":"' || replace(props, '"', '\\"') || '"}' AS content
        FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "current_pages": """
        SELECT status, CAST(size AS INT) AS rows, CAST(page * size + 1 AS INT) AS start, count(*) AS records,
               min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
        FROM (SELECT o_orderstatus AS status, o_orderkey, size,
                     (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // size AS page
              FROM orders JOIN (VALUES ('F', 300), ('O', 500), ('P', 10)) sizes(kind, size) ON o_orderstatus = kind)
        WHERE status <> 'P' OR page > 0
        GROUP BY ALL""",
    # What is current after each run; the third run of F is never complete.
    "refreshed_view": """
        SELECT version, status, CAST(size AS INT) AS rows, CAST(page * size + 1 AS INT) AS start,
               count(*) AS records, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
        FROM (SELECT version, o_orderstatus AS status, o_orderkey, size,
                     (row_number() OVER (PARTITION BY version, o_orderstatus ORDER BY o_orderkey) - 1) // size AS page
              FROM orders JOIN (
                VALUES (1, 'F', 300), (2, 'F', 300), (3, 'F', 300), (4, 'F', 300), (5, 'F', 300), (6, 'F', 300),
                       (3, 'O', 200), (4, 'O', 500), (5, 'O', 500), (6, 'O', 500), (6, 'P', 10)
              ) seen(version, kind, size) ON o_orderstatus = kind)
        WHERE status <> 'P' OR page > 0
        GROUP BY ALL""",
    # Offset by offset: which of them some landed page holds.
    "missing_pages": f"""
        WITH total AS (SELECT count(*) AS n FROM orders), {_HELD}
        SELECT '{_BASE}/recalls/' AS url, CAST(page * 250 + 1 AS INT) AS start, CAST(250 AS INT) AS rows
        FROM (SELECT DISTINCT (i - 1) // 250 AS page FROM total, range(1, n + 1) t(i)
              WHERE i NOT IN (SELECT i FROM held))""",
    "missing_offsets": f"""
        WITH total AS (SELECT count(*) AS n FROM orders), {_HELD}
        SELECT min(i) AS low, max(i) AS high
        FROM (SELECT i, i - row_number() OVER (ORDER BY i) AS island FROM total, range(1, n + 1) t(i)
              WHERE i NOT IN (SELECT i FROM held)) GROUP BY island""",
    "latest_events": """
        SELECT event_type, user_id, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "integrity_report": """
        SELECT upper(lang) AS request_type, doc_id AS path_id,
               sha256(replace(text, chr(10), ' ')) AS sha_256, sha256(text) AS content_sha_256
        FROM documents WHERE contains(text, chr(10))""",
    "malformed_bodies": """
        SELECT upper(event_type) AS request_type, event_id AS path_id FROM events
        WHERE event_type <> 'purchase'""",
    "drifted_responses": """
        WITH calls AS (
          SELECT 'EVENT' AS request_type, c_custkey AS path_id, * FROM customer
          UNION ALL SELECT 'EVENT_PRODUCTS', c_nationkey, * FROM customer
        ), copied AS (
          SELECT request_type, path_id,
                 c_custkey || CASE WHEN c_acctbal < 1000 AND c_nationkey BETWEEN 5 AND 8 THEN '!' ELSE '' END AS body
          FROM calls WHERE NOT (c_acctbal < 1000 AND c_nationkey < 3)
          UNION ALL SELECT request_type, path_id + 1000000000, c_custkey || '' FROM calls
          WHERE c_acctbal < 1000 AND c_nationkey > 20
        ), one AS (
          SELECT request_type, path_id, list_sort(list(c_custkey || '')) AS bodies FROM calls GROUP BY 1, 2
        ), two AS (
          SELECT request_type, path_id, list_sort(list(body)) AS bodies FROM copied GROUP BY 1, 2
        )
        SELECT request_type, path_id,
               CASE WHEN two.bodies IS NULL THEN 'left only' WHEN one.bodies IS NULL THEN 'right only'
                    ELSE 'changed' END AS state,
               coalesce(len(one.bodies), 0) AS left_responses, coalesce(len(two.bodies), 0) AS right_responses
        FROM one FULL JOIN two USING (request_type, path_id)
        WHERE one.bodies IS DISTINCT FROM two.bodies""",
    "coverage_report": """
        SELECT run_id, count(*) AS reported, count(DISTINCT o_orderkey) AS distinct_ids,
               CASE run_id WHEN 'plain' THEN count(*) ELSE 2 * count(*) END AS records
        FROM (SELECT unnest(['plain', 'forced']) AS run_id, o_orderkey FROM orders) GROUP BY run_id""",
    "compacted_ledger": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'EVENT' WHEN 'MACHINERY' THEN 'EVENT'
                 WHEN 'AUTOMOBILE' THEN 'CODE_INFO' ELSE 'EVENT_PRODUCTS' END AS request_type,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS path_id,
               2 * count(*) AS responses, count(*) AS bodies
        FROM customer GROUP BY 1, 2""",
    "united_files": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'EVENT' WHEN 'MACHINERY' THEN 'EVENT'
                 WHEN 'AUTOMOBILE' THEN 'CODE_INFO' ELSE 'EVENT_PRODUCTS' END AS request_type,
               without_filters, count(*) AS responses,
               count(*) FILTER (c_mktsegment <> 'MACHINERY') AS with_id
        FROM (SELECT *, unnest([true, false]) AS without_filters FROM customer) GROUP BY 1, 2""",
    "drifted_files": """
        WITH held AS (
          SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'EVENT' WHEN 'MACHINERY' THEN 'EVENT'
                   WHEN 'AUTOMOBILE' THEN 'CODE_INFO' ELSE 'EVENT_PRODUCTS' END AS request_type,
                 CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS id FROM customer
        ), written AS (
          SELECT *, CASE WHEN writer = 3 AND id % 7 = 0 THEN 'C' || id
                         WHEN writer = 3 AND id % 11 = 0 THEN '0' || id
                         WHEN writer = 4 AND id % 5 = 0 THEN id || '.5' END AS id_text
          FROM held CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS writer)
        )
        SELECT request_type, CAST(CASE WHEN id_text IS NULL THEN id END AS BIGINT) AS path_id, id_text,
               count(*) AS responses, count(*) AS whole
        FROM written GROUP BY 1, 2, 3""",
    "missing_values": """
        SELECT c AS "column",
               CASE c WHEN 'request_type' THEN (SELECT count(*) FROM documents WHERE lang = 'de' OR lang IS NULL)
                      WHEN 'content_type' THEN (SELECT count(*) FROM documents WHERE source = 'web' OR source IS NULL)
                      ELSE 0 END AS violations
        FROM (SELECT unnest(['request_type', 'url', 'signature', 'display_columns', 'content_type',
                             'content_length', 'sha_256', 'fetched_at', 'content']) AS c)""",
    "sentence_names": """
        SELECT l_orderkey, l_linenumber, CAST(pos AS INT) AS pos,
               CASE pos WHEN 0 THEN 'part_' || l_partkey WHEN 1 THEN 'supp_' || l_suppkey
                        ELSE 'line_' || l_linenumber END AS "column"
        FROM (SELECT *, unnest([0, 1, 2]) AS pos FROM lineitem)""",
    "column_lists": f"""
        SELECT doc_id, CAST(len(names) AS INT) AS names, md5(array_to_string(names, '|')) AS digest
        FROM (SELECT doc_id, list_filter(
                list_transform(regexp_split_to_array({_STRIPPED}, '{_SPACE}*,{_SPACE}*'), lambda x: lower(x)),
                lambda x: x <> '') AS names
              FROM documents)""",
    "normalized_texts": f"""
        SELECT doc_id, CAST(length(t) AS INT) AS chars, md5(t) AS digest
        FROM (SELECT doc_id, trim(regexp_replace(text, '{_SPACE}+', ' ', 'g')) AS t FROM documents)""",
    "escaped_elements": """
        SELECT doc_id, 0 AS pos, 'b' AS tag, md5(' ' || lang || ' ') AS digest FROM documents
        UNION ALL SELECT doc_id, 1, 'i', md5(text) FROM documents""",
    "page_link_texts": r"""
        SELECT page_id, CAST(pos - 1 AS INT) AS pos, text FROM (
          SELECT page_id, unnest(texts) AS text, generate_subscripts(texts, 1) AS pos FROM (
            SELECT page_id, list_transform(
                regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1),
                lambda x: html_unescaped(x)) AS texts
            FROM pages))""".replace(
        "html_unescaped(x)",
        "replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
        "'&#x27;', ''''), '&amp;', '&')",
    ),
    "spec_links": r"""
        SELECT page_id, regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'src/p' || page_id || '.json' AS spec_url
        FROM pages""",
    "endpoint_vocabulary": """
        SELECT o_orderkey, request_type, role, CAST(ordinal AS INT) AS ordinal, "column" FROM (
          SELECT o_orderkey, 'RECALLS' AS request_type, 'display' AS role, unnest([1, 2, 3]) AS ordinal,
                 unnest(['productid', 'key_' || o_orderkey, 'cust_' || o_custkey]) AS "column" FROM orders
          UNION ALL SELECT o_orderkey, 'RECALLS', 'sort', 1, 'key_' || o_orderkey FROM orders
                    WHERE o_orderpriority <> '1-URGENT'
          UNION ALL SELECT o_orderkey, 'RECALLS', 'filter', unnest([1, 2]),
                           unnest(['status_' || lower(o_orderstatus), 'center&cd']) FROM orders
          UNION ALL SELECT o_orderkey, 'PRODUCT_TYPES', 'display', unnest([1, 2]),
                           unnest(['cust_' || o_custkey, 'status_' || lower(o_orderstatus)]) FROM orders)""",
    "landed_vocabulary": """
        WITH site AS (SELECT *, 'https://docs.example/s' || s_suppkey || '/a b/' AS site FROM supplier
                      WHERE s_acctbal >= 0)
        SELECT site || 'index.html' AS page_url, 'PRODUCT_TYPES' AS request_type, 'display' AS role,
               unnest([1, 2]) AS ordinal, unnest(['supp_' || s_suppkey, 'nation_' || s_nationkey]) AS "column"
        FROM site WHERE s_nationkey >= 5
        UNION ALL
        SELECT site || 'index.html', 'not landed', '', 0, site || 'spec/s=1&p=' || s_suppkey || '.json'
        FROM site WHERE s_nationkey < 5""",
    "vocabulary_rejects": """
        SELECT request_type, 'display' AS role, 'endpoint is not in the spec' AS error,
               count(*) AS specs, min(o_orderkey) AS first_key
        FROM (SELECT o_orderkey, unnest(['EVENT', 'EVENT_PRODUCTS', 'CODE_INFO', 'PRODUCT_HISTORY',
                'EVENT_PRODUCT_HISTORY', 'PRESS_RELEASE_URLS']) AS request_type FROM orders)
        GROUP BY request_type
        UNION ALL
        SELECT 'RECALLS', 'sort', 'heading ''Sort'' occurs 2 times, not once', count(*), min(o_orderkey)
        FROM orders WHERE o_orderpriority = '1-URGENT' HAVING count(*) > 0""",
    "streamed_workset": """
        SELECT DISTINCT o_custkey AS id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer
                          WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
    "pending_requests": """
        SELECT CAST(c_custkey AS BIGINT) AS id, n AS requests, n AS tries
        FROM (SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'MACHINERY' THEN 3 WHEN 'AUTOMOBILE' THEN 2 ELSE 1 END
                AS BIGINT) AS n
              FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))""",
    "resumed_run": f"""
        SELECT o_orderkey AS path_id, '{_BASE}/recalls/product/' || o_orderkey AS url,
               octet_length(encode(body)) AS content_length, body AS content
        FROM (SELECT o_orderkey, '{{"MESSAGE": "success", "RESULTCOUNT": 1, "STATUSCODE": 400, '
                || '"RESULT": {{"COLUMNS": ["ID"], "DATA": [["' || o_orderkey || '"]]}}}}' AS body
              FROM orders)""",
    "paged_run": """
        WITH pages AS (
          SELECT CAST(page * 250 + 1 AS INT) AS start, md5(CAST(page * 250 + 1 AS VARCHAR)) AS digits,
                 count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
          FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 250 AS page FROM orders)
          GROUP BY page
        ), judged AS (
          SELECT *, CASE left(digits, 1) WHEN '0' THEN 'exhausted' WHEN '1' THEN 'terminal'
                      WHEN '2' THEN 'malformed' ELSE 'ok' END AS outcome FROM pages)
        SELECT start, outcome, CASE outcome WHEN 'ok' THEN 'kept' WHEN 'exhausted' THEN 'HTTP 503'
                 WHEN 'terminal' THEN 'HTTP 404' ELSE 'body is not one JSON object' END AS failure,
               CASE outcome WHEN 'ok' THEN n ELSE 0 END AS records,
               CASE outcome WHEN 'ok' THEN low ELSE 0 END AS first_id,
               CASE outcome WHEN 'ok' THEN high ELSE 0 END AS last_id
        FROM judged""",
    "forced_run": """
        SELECT 'PRODUCT' AS request_type, o_orderkey AS path_id, CAST(2 AS BIGINT) AS copies FROM orders
        UNION ALL
        SELECT DISTINCT 'EVENT', o_custkey, CAST(2 AS BIGINT) FROM orders""",
}
