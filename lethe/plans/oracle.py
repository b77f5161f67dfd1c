"""The catalogue's queries as plain SQL, for an independent check.

Statements are put together from the named subqueries below; a statement gets
exactly those it mentions.
"""

from __future__ import annotations

import re

from lethe.plans.overlay import CUSTOMER_PII, EVENTS_PII, ORDERS_PII, SALT
from lethe.sources.keyfile import NA_TOKENS


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    def cell(v):
        return str(v).upper() if isinstance(v, bool) else (
            _quoted(v) if v is None or isinstance(v, str) else str(v)
        )

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _extended(table: str, extra: dict[str, str]) -> str:
    return f"SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in extra.items())} FROM {table}"


_TRIM = r"regexp_replace({0}, '^[\s\x{{a0}}\x{{3000}}]+|[\s\x{{a0}}\x{{3000}}]+$', '', 'g')"
_INGESTED = "TIMESTAMP '2025-01-01 00:00:00'"
_STARTED = "TIMESTAMP '2025-02-01 00:00:00'"

_GROUPS = [
    ("CUST_EVENTS", "CUSTOMER_ID", 50, True),
    ("CUST_ORDERS", "CUSTOMER_ID", 50, True),
    ("NATION_PURGE", "NATION", 2, True),
    ("ORDERS", "ORDER_NO", 500, True),
    ("ORDERS_AGED", "ORDER_NO", 500, False),
    ("SESSIONS", "SESSION", 2000, True),
]
_RULES = [
    ("CUST_ORDERS", "lineitem", 1), ("CUST_ORDERS", "orders", 2), ("CUST_ORDERS", "customer", 3),
    ("CUST_EVENTS", "events", 1),
    ("NATION_PURGE", "lineitem", 1), ("NATION_PURGE", "orders", 2),
    ("NATION_PURGE", "customer", 3), ("NATION_PURGE", "supplier", 4),
    ("NATION_PURGE", "nation", 5),
    ("ORDERS", "lineitem", 1), ("ORDERS", "orders", 2),
    ("SESSIONS", "events", 1),
]
_MASKED = [
    ("CUST_PII", "customer", "email", 1, "fn_mask_email(email)"),
    ("CUST_PII", "customer", "phone", 1, "fn_mask_phone(phone)"),
    ("CUST_PII", "customer", "citizen_id", 1, "fn_mask_citizen_id(citizen_id)"),
    ("CUST_PII", "customer", "full_name", 1, "fn_mask_name(full_name)"),
    ("CUST_PII", "customer", "address", 1, "'CONFIDENTIAL_ADDRESS'"),
    ("CUST_PII", "orders", "contact", 2, "fn_mask_email(contact)"),
    ("CUST_PII", "orders", "note", 2,
     "regexp_replace(note, '[0-9]{10,13}', '[REDACTED_ID]')"),
    ("USER_ANON", "customer", "username", 1, "fn_mask_salted_hash(username, :salt)"),
    ("USER_ANON", "events", "actor", 2, "fn_mask_salted_hash(actor, :salt)"),
]


def email(c: str) -> str:
    d = f"substr({c}, instr({c}, '@') + 1)"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        WHEN instr({c}, '@') <= 1 THEN '***@***.***'
        ELSE substr({c}, 1, 1) || '***'
          || CASE WHEN instr({c}, '@') - 1 <= 2 THEN '' ELSE substr({c}, instr({c}, '@') - 1, 1) END
          || '@' || CASE WHEN instr({d}, '.') <= 1 THEN '******.com'
             ELSE substr({d}, 1, 1)
               || CASE WHEN instr({d}, '.') - 1 <= 2 THEN '***' ELSE '******' END
               || substr({d}, instr({d}, '.')) END END"""


def phone(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9+]', '', 'g')"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        WHEN length({d}) < 7 THEN 'XXX-XXXX'
        WHEN length({d}) = 10 THEN substr({d}, 1, 3) || '-XXX-' || substr({d}, 7, 4)
        WHEN length({d}) = 9 THEN substr({d}, 1, 2) || '-XXX-' || substr({d}, 6, 4)
        ELSE substr({d}, 1, 3) || '-XXXX-' || substr({d}, length({d}) - 3, 4) END"""


def citizen(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        WHEN length({d}) = 13 THEN substr({d}, 1, 1) || '-' || substr({d}, 2, 4) || '-XXXXX-'
          || substr({d}, 11, 2)
        ELSE substr({d}, 1, 2) || 'XXXXXXX' || right({d}, 2) END"""


def card(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        WHEN length({d}) >= 12 THEN 'XXXX-XXXX-XXXX-' || right({d}, 4) ELSE 'XXXX-XXXX' END"""


def person(c: str) -> str:
    words = f"list_filter(string_split(trim({c}, ' '), ' '), lambda w: length(w) > 0)"
    star = "lambda w: substr(w, 1, 1) || repeat('*', CAST(greatest(length(w) - 1, 3) AS INTEGER))"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        ELSE array_to_string(list_transform({words}, {star}), ' ') END"""


def hashed(c: str, salt: str) -> str:
    return f"'MSK_' || substr(sha256({c} || '{salt}'), 1, 12)"


def partial(c: str, start: int, end: int, char: str) -> str:
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN {c}
        WHEN length({c}) <= {start + end} THEN repeat('{char}', CAST(length({c}) AS INTEGER))
        ELSE substr({c}, 1, {start})
          || repeat('{char}', CAST(length({c}) - {start + end} AS INTEGER))
          || substr({c}, length({c}) - {end} + 1, {end}) END"""


def bucket(text: str, n: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {n})"


def redacted(c: str) -> str:
    return f"regexp_replace({c}, '[0-9]{{10,13}}', '[REDACTED_ID]', 'g')"


def pct(part: str, whole: str) -> str:
    return f"CAST(round({part} * 100.0 / NULLIF({whole}, 0), 2) AS DOUBLE)"


def _hit(group: str, table: str, order: int, rows: str) -> str:
    """``rows`` selects chunk_no once per reached row."""
    return (
        f"SELECT '{group}' AS group_code, '{table}' AS target_table, {order} AS execution_order, "
        f"chunk_no, count(*) AS n FROM ({rows}) GROUP BY chunk_no"
    )


def _direct(group: str, table: str, column: str, keys: str = "kv") -> str:
    return (
        f"SELECT k.chunk_no FROM {table} t JOIN {keys} k "
        f"ON k.group_code = '{group}' AND t.{column} = k.v"
    )


_CUST_LINES = """SELECT o.chunk_no FROM lineitem l JOIN (
    SELECT o_orderkey, min(k.chunk_no) AS chunk_no FROM orders
    JOIN kv k ON k.group_code = 'CUST_ORDERS' AND o_custkey = k.v GROUP BY 1) o
    ON l.l_orderkey = o.o_orderkey"""
_NATION_ORDERS = """SELECT o_orderkey, k.chunk_no FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN kv k ON k.group_code = 'NATION_PURGE' AND c_nationkey = k.v"""

_HITS = [
    _hit("CUST_ORDERS", "lineitem", 1, _CUST_LINES),
    _hit("CUST_ORDERS", "orders", 2, _direct("CUST_ORDERS", "orders", "o_custkey")),
    _hit("CUST_ORDERS", "customer", 3, _direct("CUST_ORDERS", "customer", "c_custkey")),
    _hit("CUST_EVENTS", "events", 1, _direct("CUST_EVENTS", "events", "user_id")),
    _hit("NATION_PURGE", "lineitem", 1,
         f"SELECT o.chunk_no FROM lineitem JOIN ({_NATION_ORDERS}) o ON l_orderkey = o.o_orderkey"),
    _hit("NATION_PURGE", "orders", 2, _NATION_ORDERS),
    _hit("NATION_PURGE", "customer", 3, _direct("NATION_PURGE", "customer", "c_nationkey")),
    _hit("NATION_PURGE", "supplier", 4, _direct("NATION_PURGE", "supplier", "s_nationkey")),
    _hit("NATION_PURGE", "nation", 5, _direct("NATION_PURGE", "nation", "n_nationkey")),
    _hit("ORDERS", "lineitem", 1, _direct("ORDERS", "lineitem", "l_orderkey")),
    _hit("ORDERS", "orders", 2, _direct("ORDERS", "orders", "o_orderkey")),
    _hit("SESSIONS", "events", 1, _direct("SESSIONS", "events", "user_id")),
]


# groups run in the order of their codes, each on what the ones before left
_OURS = "(SELECT v FROM cust_keys)"
_LEFT_ORDERS = f"""SELECT o_orderkey, k.chunk_no FROM orders
    JOIN customer ON o_custkey = c_custkey AND o_custkey NOT IN {_OURS}
    JOIN kv k ON k.group_code = 'NATION_PURGE' AND c_nationkey = k.v"""
_GONE = """(SELECT o_orderkey FROM cust_orders UNION SELECT o_orderkey FROM nation_orders)"""
_HITS_IN_TURN = [
    *_HITS[:4],
    _hit("NATION_PURGE", "lineitem", 1,
         f"SELECT o.chunk_no FROM lineitem JOIN ({_LEFT_ORDERS}) o ON l_orderkey = o.o_orderkey"),
    _hit("NATION_PURGE", "orders", 2, _LEFT_ORDERS),
    _hit("NATION_PURGE", "customer", 3,
         _direct("NATION_PURGE", "customer", "c_nationkey") + f" WHERE c_custkey NOT IN {_OURS}"),
    *_HITS[7:9],
    _hit("ORDERS", "lineitem", 1,
         _direct("ORDERS", "lineitem", "l_orderkey") + f" WHERE l_orderkey NOT IN {_GONE}"),
    _hit("ORDERS", "orders", 2,
         _direct("ORDERS", "orders", "o_orderkey") + f" WHERE o_orderkey NOT IN {_GONE}"),
    _hit("SESSIONS", "events", 1,
         _direct("SESSIONS", "events", "user_id") + f" WHERE user_id NOT IN {_OURS}"),
]


def _found(group: str, table: str, column: str) -> str:
    return (
        f"SELECT group_code, key_no FROM pending WHERE group_code = '{group}' "
        f"AND try_cast(key_no AS BIGINT) IN (SELECT {column} FROM {table})"
    )


_REPORT = "('CUST_EVENTS', 'CUST_ORDERS', 'NATION_PURGE', 'ORDERS', 'SESSIONS')"
_RAN = "('CUST_EVENTS', 'CUST_ORDERS', 'NATION_PURGE', 'SESSIONS')"

SUBQUERIES = {
    "customer_pii": _extended("customer", CUSTOMER_PII),
    "orders_pii": _extended("orders", ORDERS_PII),
    "events_pii": _extended("events", EVENTS_PII),
    "raw_keys": """
        SELECT 'CUSTOMER_ID' AS key_type, CAST(c_custkey AS VARCHAR) AS key_no
            FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'CUSTOMER_ID', '  ' || CAST(c_custkey AS VARCHAR) || ' '
            FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'ORDER_NO', CAST(o_orderkey AS VARCHAR)
            FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'NATION', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_regionkey = 3
        UNION ALL SELECT 'SESSION', CAST(c_custkey AS VARCHAR)
            FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT * FROM (VALUES
            ('CUSTOMER_ID', 'DUMMY-99901'), ('CUSTOMER_ID', 'DUMMY-99902'),
            ('CUSTOMER_ID', '007'), ('CUSTOMER_ID', ''), ('CUSTOMER_ID', '   '),
            ('CUSTOMER_ID', 'NA'), ('CUSTOMER_ID', NULL), ('ORDER_NO', 'DUMMY-99901'),
            ('SESSION', chr(160) || 'DUMMY-99903' || chr(12288)))""",
    "clean_keys": f"""
        SELECT key_type, {_TRIM.format('key_no')} AS key_no FROM raw_keys
        WHERE key_no IS NOT NULL
          AND key_no NOT IN ({', '.join(_quoted(t) for t in NA_TOKENS)})
          AND {_TRIM.format('key_no')} <> ''""",
    "items": f"""SELECT DISTINCT 'BATCH-2025' AS batch_id, key_type, key_no,
        {_INGESTED} AS created_at FROM clean_keys""",
    "grp": _values(_GROUPS, "group_code, key_type, chunk_size, is_active"),
    "rul": _values(_RULES, "group_code, target_table, execution_order"),
    "pending": """SELECT batch_id, items.key_type, group_code, key_no, 'PENDING' AS status,
        created_at FROM items JOIN grp ON items.key_type = grp.key_type AND is_active""",
    "found": " UNION ALL ".join(
        [
            _found("CUST_EVENTS", "events", "user_id"),
            _found("CUST_ORDERS", "customer", "c_custkey"),
            _found("NATION_PURGE", "nation", "n_nationkey"),
            _found("ORDERS", "orders", "o_orderkey"),
            _found("SESSIONS", "events", "user_id"),
        ]
    ),
    "tasks": """SELECT p.* EXCLUDE (status), CASE WHEN EXISTS (SELECT 1 FROM found f
            WHERE f.group_code = p.group_code AND f.key_no = p.key_no)
            THEN 'VALIDATED' ELSE 'NOT_FOUND' END AS status FROM pending p""",
    "chunks": """SELECT t.group_code, key_no, CAST(floor((row_number() OVER (
            PARTITION BY t.group_code ORDER BY key_no) - 1) / chunk_size) AS INTEGER) + 1
            AS chunk_no
        FROM tasks t JOIN grp USING (group_code) WHERE status = 'VALIDATED'""",
    "kv": """SELECT group_code, try_cast(key_no AS BIGINT) AS v, min(chunk_no) AS chunk_no
        FROM chunks GROUP BY 1, 2 HAVING try_cast(key_no AS BIGINT) IS NOT NULL""",
    "hits": " UNION ALL ".join(_HITS),
    "hits_in_turn": " UNION ALL ".join(_HITS_IN_TURN),
    "summary": f"""SELECT 'BATCH-2025' AS batch_id, r.*,
            CAST(coalesce(sum(n), 0) AS BIGINT) AS estimated_rows_to_delete,
            {_INGESTED} AS executed_at
        FROM rul r LEFT JOIN hits USING (group_code, target_table, execution_order)
        GROUP BY ALL""",
    "report_summary": f"SELECT * FROM summary WHERE group_code IN {_REPORT}",
    "run_summary": """SELECT * FROM report_summary
        WHERE NOT (group_code = 'CUST_ORDERS' AND execution_order = 3)""",
    "all_audit": """SELECT 'BATCH-2025' AS batch_id, r.*, c.chunk_no,
            CAST(coalesce(n, 0) AS BIGINT) AS deleted_row_count
        FROM rul r JOIN (SELECT DISTINCT group_code, chunk_no FROM chunks) c USING (group_code)
        LEFT JOIN hits h ON h.group_code = r.group_code AND h.target_table = r.target_table
            AND h.execution_order = r.execution_order AND h.chunk_no = c.chunk_no""",
    "audit": f"""SELECT *, {_STARTED} + to_seconds((chunk_no - 1) * 20) AS started_at,
            {_STARTED} + to_seconds(chunk_no * 20) AS executed_at
        FROM all_audit WHERE group_code IN {_RAN}""",
    "finished": f"""SELECT t.* EXCLUDE (status),
            CASE WHEN t.group_code IN {_RAN} AND chunk_no IS NOT NULL THEN 'COMPLETED'
                 WHEN t.group_code = 'ORDERS' AND chunk_no = 2 THEN 'FAILED'
                 ELSE status END AS status,
            CASE WHEN t.group_code = 'ORDERS' AND chunk_no = 2 THEN 'chunk 2 was aborted' END
                AS error_message,
            CASE WHEN t.group_code IN {_RAN} OR (t.group_code = 'ORDERS' AND chunk_no = 2)
                 THEN {_STARTED} + to_seconds(chunk_no * 20) END AS processed_at
        FROM tasks t LEFT JOIN chunks c USING (group_code, key_no)
        WHERE t.group_code IN {_REPORT}""",
    "report_tasks": f"SELECT * FROM tasks WHERE group_code IN {_REPORT}",
    # masking
    "mask_grp": _values(
        [("CUST_PII", "CUSTOMER_ID", 50), ("USER_ANON", "CUSTOMER_ID", 100)],
        "group_code, key_type, chunk_size",
    ),
    "mask_rul": _values(
        _MASKED, "group_code, target_table, column_name, execution_order, mask_expression"
    ),
    "mask_pending": """SELECT batch_id, items.key_type, group_code, key_no, 'PENDING' AS status
        FROM items JOIN mask_grp USING (key_type)""",
    "mask_tasks": """SELECT p.* EXCLUDE (status), CASE WHEN try_cast(key_no AS BIGINT) IN (
            SELECT c_custkey FROM customer) THEN 'VALIDATED' ELSE 'NOT_FOUND' END AS status
        FROM mask_pending p""",
    "mask_chunks": """SELECT t.group_code, key_no, CAST(floor((row_number() OVER (
            PARTITION BY t.group_code ORDER BY key_no) - 1) / chunk_size) AS INTEGER) + 1
            AS chunk_no
        FROM mask_tasks t JOIN mask_grp USING (group_code) WHERE status = 'VALIDATED'""",
    "mask_kv": """SELECT group_code, try_cast(key_no AS BIGINT) AS v, min(chunk_no) AS chunk_no
        FROM mask_chunks GROUP BY 1, 2""",
    "mask_hits": " UNION ALL ".join(
        [
            _hit("CUST_PII", "customer", 1, _direct("CUST_PII", "customer", "c_custkey",
                                                    "mask_kv")),
            _hit("CUST_PII", "orders", 2, _direct("CUST_PII", "orders", "o_custkey", "mask_kv")),
            _hit("USER_ANON", "customer", 1, _direct("USER_ANON", "customer", "c_custkey",
                                                     "mask_kv")),
            _hit("USER_ANON", "events", 2, """SELECT k.chunk_no FROM events_pii
                JOIN customer_pii ON actor = username
                JOIN mask_kv k ON k.group_code = 'USER_ANON' AND c_custkey = k.v"""),
        ]
    ),
    "mask_steps": """SELECT group_code, target_table, execution_order,
            string_agg(column_name, ', ' ORDER BY column_name) AS columns_masked
        FROM mask_rul GROUP BY 1, 2, 3""",
    "mask_audit_rows": """SELECT s.group_code, s.target_table, columns_masked, s.execution_order,
            CAST(coalesce(n, 0) AS BIGINT) AS masked_row_count, c.chunk_no AS chunk_number
        FROM mask_steps s
        JOIN (SELECT DISTINCT group_code, chunk_no FROM mask_chunks) c USING (group_code)
        LEFT JOIN mask_hits h ON h.group_code = s.group_code AND h.target_table = s.target_table
            AND h.execution_order = s.execution_order AND h.chunk_no = c.chunk_no""",
    "timed_mask_audit": f"""SELECT *,
            CAST(masked_row_count * 0.001 + 0.1 AS DECIMAL(10, 3)) AS duration_sec,
            {_STARTED} + to_seconds(chunk_number * 20) AS processed_at FROM mask_audit_rows""",
    "hit_customers": "SELECT v FROM mask_kv WHERE group_code = 'CUST_PII'",
    "hit_users": "SELECT v FROM mask_kv WHERE group_code = 'USER_ANON'",
    "masked_pairs": " UNION ALL ".join(
        f"SELECT '{g}' AS group_code, '{t}' AS target_table, '{c}' AS column_name, "
        f"{k if k != 'actor' else 'CAST(NULL AS BIGINT)'} AS key, "
        f"{k if k == 'actor' else 'CAST(NULL AS VARCHAR)'} AS text_key, {c} AS before, "
        f"{sql} AS after FROM {t}_pii WHERE {k} IN ({of})"
        for g, t, k, c, sql, of in [
            *[("CUST_PII", *rest, "SELECT v FROM hit_customers") for rest in [
                ("customer", "c_custkey", "email", email("email")),
                ("customer", "c_custkey", "phone", phone("phone")),
                ("customer", "c_custkey", "citizen_id", citizen("citizen_id")),
                ("customer", "c_custkey", "full_name", person("full_name")),
                ("customer", "c_custkey", "address", "'CONFIDENTIAL_ADDRESS'"),
                ("orders", "o_custkey", "contact", email("contact")),
                ("orders", "o_custkey", "note", redacted("note")),
            ]],
            ("USER_ANON", "customer", "c_custkey", "username", hashed("username", SALT),
             "SELECT v FROM hit_users"),
            ("USER_ANON", "events", "actor", "actor", hashed("actor", SALT),
             "SELECT username FROM customer_pii WHERE c_custkey IN (SELECT v FROM hit_users)"),
        ]
    ),
    "previews": """SELECT group_code, target_table, column_name, before, after, row_number() OVER (
            PARTITION BY group_code, target_table, column_name
            ORDER BY key, text_key, before, after) AS sample_index
        FROM masked_pairs WHERE before IS NOT NULL QUALIFY sample_index <= 5""",
    # configuration
    "sup_grp": """SELECT 'SUP_' || s_suppkey AS group_code,
            CASE WHEN s_nationkey < 10 THEN 'PART_NO' ELSE 'LINE_NO' END AS key_type,
            s_name AS description, 500 AS chunk_size, CAST(0.05 AS DECIMAL(4, 2)) AS throttle_sec,
            s_acctbal >= 0 AS is_active FROM supplier""",
    "sup_rul": """SELECT DISTINCT 'SUP_' || l_suppkey AS group_code,
            'lines_' || l_linenumber AS target_table, l_linenumber AS execution_order,
            'l_suppkey' AS key_path FROM lineitem""",
    # all keys of the file, typed
    "typed": """SELECT DISTINCT key_type, try_cast(key_no AS BIGINT) AS v FROM items
        WHERE try_cast(key_no AS BIGINT) IS NOT NULL""",
    "cust_keys": "SELECT v FROM typed WHERE key_type = 'CUSTOMER_ID'",
    "nation_keys": "SELECT v FROM typed WHERE key_type = 'NATION'",
    "order_keys": "SELECT v FROM typed WHERE key_type = 'ORDER_NO'",
    "session_keys": "SELECT v FROM typed WHERE key_type = 'SESSION'",
    "nation_customers": """SELECT c_custkey FROM customer
        WHERE c_nationkey IN (SELECT v FROM nation_keys)""",
    "nation_orders": """SELECT o_orderkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM nation_customers)""",
    "cust_orders": "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT v FROM cust_keys)",
}


def _with(body: str) -> str:
    """``body`` preceded by the subqueries it needs, in order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        words = set(re.findall(r"[a-z_]+", sql))
        for name, text in SUBQUERIES.items():
            if name in words and name not in needed:
                visit(text)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({SUBQUERIES[name]})" for name in needed)
    return f"WITH {parts}\n{body}"


def _count(condition: str | None = None) -> str:
    return f"count(*) FILTER (WHERE status IN ({condition}))" if condition else "count(*)"


_VALID = _count("'VALIDATED', 'COMPLETED'")
_SAME = "group_code, target_table, execution_order"
_LINES = "l_orderkey, l_linenumber, l_partkey"


def _left(names: dict[str, str | None]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_left FROM {t}"
        + (f" WHERE NOT ({hit})" if hit else "")
        for t, hit in names.items()
    )


_BODIES = {
    "keys_csv": "SELECT DISTINCT key_type, key_no FROM clean_keys",
    "keys_detect_columns": """
        SELECT 'type_and_value' AS case_name, key_type, key_no FROM raw_keys
        UNION ALL SELECT 'order_column', 'ORDER_NO', CAST(o_orderkey AS VARCHAR) FROM orders
        UNION ALL SELECT 'customer_column', 'CUSTOMER_ID', CAST(c_custkey AS VARCHAR) FROM customer
        UNION ALL SELECT 'first_column', 'SUPPLIER_ID', CAST(s_suppkey AS VARCHAR) FROM supplier""",
    "keys_clean": "SELECT key_type, key_no FROM clean_keys",
    "keys_dedup": "SELECT DISTINCT key_type, key_no FROM clean_keys",
    "keys_dedup_count": """SELECT count(*) AS total_keys,
        count(DISTINCT key_type || '|' || key_no) AS unique_keys,
        count(*) - count(DISTINCT key_type || '|' || key_no) AS duplicates FROM clean_keys""",
    "keys_upsert": "SELECT batch_id, key_type, key_no FROM items WHERE key_type <> 'CUSTOMER_ID'",
    "keys_breakdown": """SELECT batch_id, key_type, count(*) AS key_count FROM items
        GROUP BY 1, 2""",
    "keys_errors": """SELECT 'good' AS case_name, TRUE AS accepted, count(*) AS keys FROM items
        UNION ALL SELECT * FROM (VALUES ('empty', FALSE, 0), ('missing', FALSE, 0),
            ('format', FALSE, 0))""",
    "table_snapshot_write": """SELECT * FROM customer
        WHERE c_nationkey NOT IN (SELECT v FROM nation_keys)""",
    "snapshot_expire": """SELECT
            count(*) FILTER (WHERE c_nationkey NOT IN (SELECT v FROM nation_keys)) AS rows_left,
            count(DISTINCT c_nationkey) FILTER (WHERE c_nationkey IN (SELECT v FROM nation_keys))
                AS partitions_removed,
            CAST(1 AS BIGINT) AS commits_left FROM customer""",
    "audit_append": f"""SELECT 'BATCH-2025' AS batch_id, {_SAME}, c.chunk_no,
            CAST(coalesce(n, 0) AS BIGINT) AS deleted_row_count
        FROM rul r JOIN (SELECT DISTINCT group_code, chunk_no FROM chunks) c USING (group_code)
        LEFT JOIN hits_in_turn h USING (group_code, target_table, execution_order, chunk_no)""",
    "summary_replace": f"""SELECT batch_id, {_SAME},
        CASE WHEN group_code = 'ORDERS' THEN -1 ELSE estimated_rows_to_delete END
            AS estimated_rows_to_delete FROM report_summary""",
    "config_upsert_group": """
        WITH new AS (SELECT 'SUP_' || (l_suppkey + 50) AS group_code, 'RETURN_NO' AS key_type,
            'returned lines' AS description, CAST(count(*) AS INTEGER) AS chunk_size,
            CAST(0.10 AS DECIMAL(4, 2)) AS throttle_sec, TRUE AS is_active
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey)
        SELECT coalesce(o.group_code, n.group_code) AS group_code,
            coalesce(n.key_type, o.key_type) AS key_type,
            coalesce(n.description, o.description) AS description,
            coalesce(o.chunk_size, n.chunk_size) AS chunk_size,
            coalesce(o.throttle_sec, n.throttle_sec) AS throttle_sec,
            coalesce(n.is_active, o.is_active) AS is_active
        FROM sup_grp o FULL OUTER JOIN new n ON o.group_code = n.group_code""",
    "config_upsert_rule": """
        WITH late AS (SELECT DISTINCT 'SUP_' || l_suppkey AS group_code,
            'final_lines' AS target_table, l_linenumber + 3 AS execution_order,
            'l_partkey' AS key_path FROM lineitem WHERE l_linestatus = 'F')
        SELECT coalesce(n.group_code, o.group_code) AS group_code,
            coalesce(n.target_table, o.target_table) AS target_table,
            coalesce(n.execution_order, o.execution_order) AS execution_order,
            coalesce(n.key_path, o.key_path) AS key_path
        FROM sup_rul o FULL OUTER JOIN late n
            ON o.group_code = n.group_code AND o.execution_order = n.execution_order""",
    "config_overview": """SELECT g.group_code, key_type, chunk_size, throttle_sec, is_active,
        count(r.group_code) AS total_rules, description
        FROM sup_grp g LEFT JOIN sup_rul r ON g.group_code = r.group_code GROUP BY ALL""",
    "config_rule_order": """SELECT group_code, key_type, execution_order, target_table, key_path
        FROM sup_rul JOIN sup_grp USING (group_code)""",
    "config_active_filter": """SELECT r.*, TRUE AS is_active
        FROM sup_rul r JOIN sup_grp g USING (group_code)
        WHERE g.is_active AND execution_order <> 2""",
    "config_deactivate_conflicts": """SELECT group_code, key_type,
        is_active AND NOT (key_type = 'PART_NO' AND group_code <> 'SUP_1') AS is_active
        FROM sup_grp""",
    "expand_tasks": "SELECT batch_id, key_type, group_code, key_no, status FROM pending",
    "expand_tasks_skip": """SELECT batch_id, key_type, group_code, key_no, status FROM pending
        WHERE key_type = 'CUSTOMER_ID' AND group_code <> 'CUST_EVENTS'""",
    "expand_tasks_mask": """SELECT batch_id, key_type, group_code, key_no, status
        FROM mask_pending""",
    "validate_root": "SELECT group_code, key_no, status FROM tasks",
    "validate_first": "SELECT group_code, key_no, status FROM mask_tasks",
    "root_rule_pick": """
        SELECT 'root' AS picked, group_code, target_table, execution_order FROM sup_rul
            QUALIFY row_number() OVER (PARTITION BY group_code ORDER BY execution_order DESC) = 1
        UNION ALL SELECT 'first', group_code, target_table, execution_order FROM sup_rul
            QUALIFY row_number() OVER (PARTITION BY group_code ORDER BY execution_order) = 1""",
    "group_scope": """SELECT DISTINCT group_code, grp.key_type FROM grp JOIN tasks
        USING (group_code) WHERE is_active AND status = 'VALIDATED'""",
    "missing_keys": """SELECT r.target_table AS root_target_table, key_type, key_no, status
        FROM tasks t JOIN rul r ON r.group_code = t.group_code AND r.execution_order = (
            SELECT max(execution_order) FROM rul x WHERE x.group_code = t.group_code)
        WHERE status = 'NOT_FOUND'""",
    "path_direct": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey IN (SELECT v FROM cust_keys)""",
    "path_one_hop": f"""SELECT {_LINES} FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM cust_orders)""",
    "path_two_hop": f"""SELECT {_LINES} FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM nation_orders)""",
    "path_multi_branch": f"""SELECT {_SAME}, estimated_rows_to_delete FROM summary
        WHERE group_code = 'NATION_PURGE'""",
    "path_typed": """SELECT c_custkey, c_name FROM customer
        WHERE c_custkey IN (SELECT v FROM cust_keys)""",
    "path_filtered": """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderkey IN (SELECT v FROM order_keys)
          AND o_orderdate < DATE '2005-01-01' - INTERVAL 7 YEAR""",
    "path_case_insensitive": """SELECT c_custkey, username FROM customer_pii
        WHERE upper(username) IN (SELECT upper(username) FROM customer_pii
            WHERE c_acctbal < 0)""",
    "path_flat": """SELECT event_id, user_id FROM events
        WHERE user_id IN (SELECT v FROM session_keys)""",
    "estimate_delete": f"SELECT {_SAME}, estimated_rows_to_delete FROM summary",
    "estimate_mask": """SELECT r.group_code, r.target_table, column_name, r.execution_order,
        mask_expression, CAST(coalesce(sum(n), 0) AS BIGINT) AS estimated_rows_to_mask
        FROM mask_rul r LEFT JOIN mask_hits h ON h.group_code = r.group_code
            AND h.target_table = r.target_table AND h.execution_order = r.execution_order
        GROUP BY ALL""",
    "mask_preview": "SELECT group_code, target_table, column_name, before, after FROM previews",
    "mask_preview_failsoft": """SELECT 'customer' AS target_table, 'email' AS column_name,
            CAST(count(*) AS INTEGER) AS samples FROM previews WHERE column_name = 'email'
        UNION ALL SELECT * FROM (VALUES ('customer', 'phone', 0), ('customer', 'address', 0))""",
    "preview_unpack": """SELECT group_code, target_table, column_name,
        CAST(sample_index AS INTEGER) AS sample_index, before AS sample_original_value,
        after AS sample_masked_value FROM previews""",
    "assign_chunks": "SELECT group_code, key_no, chunk_no FROM chunks",
    "purge_rows": """SELECT * FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM cust_orders)""",
    "purge_up_to_order": _left(
        {
            "lineitem": "l_orderkey IN (SELECT o_orderkey FROM cust_orders)",
            "orders": "o_custkey IN (SELECT v FROM cust_keys)",
            "customer": None,
        }
    ),
    "purge_multi_group": _left(
        {
            "customer": """c_custkey IN (SELECT v FROM cust_keys)
                OR c_nationkey IN (SELECT v FROM nation_keys)""",
            "events": """user_id IN (SELECT v FROM cust_keys)
                OR user_id IN (SELECT v FROM session_keys)""",
            "lineitem": """l_orderkey IN (SELECT o_orderkey FROM cust_orders)
                OR l_orderkey IN (SELECT o_orderkey FROM nation_orders)
                OR l_orderkey IN (SELECT v FROM order_keys)""",
            "nation": "n_nationkey IN (SELECT v FROM nation_keys)",
            "orders": """o_orderkey IN (SELECT o_orderkey FROM cust_orders)
                OR o_orderkey IN (SELECT o_orderkey FROM nation_orders)
                OR o_orderkey IN (SELECT v FROM order_keys)""",
            "supplier": "s_nationkey IN (SELECT v FROM nation_keys)",
        }
    ),
    "purge_audit": f"SELECT {_SAME}, chunk_no, deleted_row_count FROM all_audit",
    "task_complete": "SELECT group_code, key_no, status, processed_at FROM finished",
    "resume_batch": """SELECT group_code, key_no,
        CASE status WHEN 'VALIDATED' THEN 'COMPLETED' ELSE status END AS status
        FROM tasks""",
    "mask_email": f"SELECT c_custkey, {email('email')} AS masked FROM customer_pii",
    "mask_phone": f"SELECT c_custkey, {phone('phone')} AS masked FROM customer_pii",
    "mask_citizen_id": f"SELECT c_custkey, {citizen('citizen_id')} AS masked FROM customer_pii",
    "mask_credit_card": f"SELECT c_custkey, {card('card')} AS masked FROM customer_pii",
    "mask_name": f"SELECT c_custkey, {person('full_name')} AS masked FROM customer_pii",
    "mask_salted_hash": f"""SELECT c_custkey, {hashed('email', 'MASKING_SALT_2026')} AS masked
        FROM customer_pii""",
    "mask_partial": f"SELECT c_custkey, {partial('phone', 3, 3, 'X')} AS masked FROM customer_pii",
    "mask_date_shift": f"""SELECT o_orderkey, CAST(o_orderdate + to_days(CAST(-45
        + {bucket("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", 91)} AS INTEGER)) AS DATE)
        AS masked FROM orders_pii""",
    "mask_static": "SELECT c_custkey, 'CONFIDENTIAL_ADDRESS' AS masked FROM customer",
    "mask_null": "SELECT c_custkey, CAST(NULL AS VARCHAR) AS masked FROM customer",
    "mask_sequential": """SELECT o_orderkey,
        'REDACTED_ADDR_' || lpad(CAST(o_orderkey AS VARCHAR), 4, '0') AS masked FROM orders""",
    "mask_unique_alias": """SELECT c_custkey, 'user_' || c_custkey || '@masked.internal' AS masked
        FROM customer""",
    "mask_numeric_noise": f"""SELECT o_orderkey, CAST(round(
            CAST(o_totalprice AS DECIMAL(18, 2))
            * CAST(85 + {bucket("CAST(o_orderkey AS VARCHAR)", 30)} AS DECIMAL(5, 0))
            / 100 / 100) * 100 AS DOUBLE) AS masked FROM orders""",
    "mask_conditional": f"""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING'
        THEN 'CONFIDENTIAL_VIP' ELSE {person('full_name')} END AS masked FROM customer_pii""",
    "mask_custom_expr": f"""SELECT c_custkey, CASE WHEN email IS NULL
        THEN {partial('username', 1, 3, '*')}
        ELSE {email('email')} || '/' || {phone('phone')} END AS masked FROM customer_pii""",
    "mask_regex_redact": f"SELECT doc_id, {redacted('text')} AS masked FROM documents",
    "mask_json_merge": """SELECT c_custkey, payload ->> '$.tier' AS tier,
        CAST(payload ->> '$.visits' AS BIGINT) AS visits, '***' AS cvv, 'XXX-XX-XXXX' AS ssn
        FROM customer_pii""",
    "mask_apply": f"""SELECT * EXCLUDE (hit) REPLACE (
            CASE WHEN hit THEN {email('email')} ELSE email END AS email,
            CASE WHEN hit THEN {phone('phone')} ELSE phone END AS phone,
            CASE WHEN hit THEN {citizen('citizen_id')} ELSE citizen_id END AS citizen_id,
            CASE WHEN hit THEN {person('full_name')} ELSE full_name END AS full_name,
            CASE WHEN hit THEN 'CONFIDENTIAL_ADDRESS' ELSE address END AS address)
        FROM (SELECT *, c_custkey IN (SELECT v FROM hit_customers) AS hit FROM customer_pii)""",
    "mask_rule_grouping": """
        WITH r AS (SELECT DISTINCT 'SUP_' || l_suppkey AS group_code,
            'column_' || l_linenumber AS c, l_linenumber % 2 + 1 AS execution_order
            FROM lineitem WHERE l_linenumber <> 7)
        SELECT group_code, 'lineitem' AS target_table, 'l_suppkey' AS key_path, execution_order,
            string_agg(c || ' = (fn_mask_name(' || c || '))', ', ' ORDER BY c) AS set_clause,
            string_agg(c, ', ' ORDER BY c) AS columns_masked
        FROM r GROUP BY group_code, execution_order""",
    "mask_max_order": """SELECT 'address' AS column_name, count(*) AS changed_rows FROM customer
            WHERE c_custkey IN (SELECT v FROM hit_customers)
        UNION ALL SELECT 'contact', CAST(0 AS BIGINT)""",
    "mask_multi_table": " UNION ALL ".join(
        f"SELECT '{g}' AS group_code, '{t}' AS table_name, {key} AS row_key, '{c}' AS column_name, "
        f"CASE WHEN {k} IN ({of}) THEN {sql} ELSE {c} END AS masked FROM {t}_pii"
        for g, t, key, k, c, sql, of in [
            *[("CUST_PII", *rest, "SELECT v FROM hit_customers") for rest in [
                ("customer", "c_custkey", "c_custkey", "email", email("email")),
                ("customer", "c_custkey", "c_custkey", "phone", phone("phone")),
                ("customer", "c_custkey", "c_custkey", "citizen_id", citizen("citizen_id")),
                ("customer", "c_custkey", "c_custkey", "full_name", person("full_name")),
                ("customer", "c_custkey", "c_custkey", "address", "'CONFIDENTIAL_ADDRESS'"),
                ("orders", "o_orderkey", "o_custkey", "contact", email("contact")),
                ("orders", "o_orderkey", "o_custkey", "note", redacted("note")),
            ]],
            ("USER_ANON", "customer", "c_custkey", "c_custkey", "username",
             hashed("username", SALT), "SELECT v FROM hit_users"),
            ("USER_ANON", "events", "event_id", "actor", "actor", hashed("actor", SALT),
             "SELECT username FROM customer_pii WHERE c_custkey IN (SELECT v FROM hit_users)"),
        ]
    ),
    "mask_join_preserving": """
        WITH j AS (SELECT count(DISTINCT actor) AS actors, count(*) AS joined_rows
            FROM customer_pii JOIN events_pii ON username = actor)
        SELECT 'before' AS state, * FROM j UNION ALL SELECT 'after', * FROM j""",
    "mask_audit": "SELECT * FROM mask_audit_rows",
    "rpt_ingest_mapping": f"""SELECT {_SAME}, t.key_type,
        count(DISTINCT t.key_no) AS master_keys_count, count(t.key_no) AS mapped_tasks_count,
        min(t.created_at) AS ingested_at
        FROM report_tasks t JOIN rul USING (group_code) GROUP BY ALL""",
    "rpt_match_rate": f"""SELECT {_SAME}, count(*) AS total_tasks, {_VALID} AS valid_matched_keys,
        {_count("'NOT_FOUND'")} AS not_found_keys, {_count("'PENDING'")} AS pending_tasks,
        {pct(_VALID, 'count(*)')} AS match_rate_pct
        FROM report_tasks JOIN rul USING (group_code) GROUP BY {_SAME}""",
    "rpt_missing": """SELECT r.target_table AS root_target_table, key_type, key_no, status,
            created_at
        FROM finished t JOIN rul r ON r.group_code = t.group_code AND r.execution_order = (
            SELECT max(execution_order) FROM rul x WHERE x.group_code = t.group_code)
        WHERE status = 'NOT_FOUND'""",
    "rpt_estimates": "SELECT * FROM report_summary",
    "rpt_signoff": f"""
        WITH b AS (SELECT batch_id, count(DISTINCT key_no) AS total_master_keys,
                string_agg(DISTINCT key_type, ', ' ORDER BY key_type) AS key_types
                FROM items GROUP BY 1),
            s AS (SELECT batch_id, {_SAME}, {_VALID} AS valid_matched_keys,
                {_count("'NOT_FOUND'")} AS not_found_keys,
                {pct(_VALID, 'count(*)')} AS match_rate_pct
                FROM finished JOIN rul USING (group_code) GROUP BY batch_id, {_SAME})
        SELECT s.batch_id, s.group_code, s.target_table, s.execution_order, key_types,
            total_master_keys, valid_matched_keys, not_found_keys, match_rate_pct,
            coalesce(estimated_rows_to_delete, 0) AS estimated_rows_to_purge
        FROM s JOIN b USING (batch_id) LEFT JOIN run_summary d ON d.group_code = s.group_code
            AND d.target_table = s.target_table AND d.execution_order = s.execution_order""",
    "rpt_signoff_totals": """
        WITH k AS (SELECT group_code, count(*) FILTER (WHERE status = 'NOT_FOUND') AS skipped_keys
            FROM report_tasks GROUP BY ROLLUP (group_code))
        SELECT r.group_code, target_table, rows_to_purge, skipped_keys FROM (
            SELECT group_code, target_table,
                CAST(sum(estimated_rows_to_delete) AS BIGINT) AS rows_to_purge
            FROM report_summary GROUP BY ROLLUP (group_code, target_table)) r
        LEFT JOIN k ON r.group_code IS NOT DISTINCT FROM k.group_code
            AND r.target_table IS NULL""",
    "rpt_progress": f"""SELECT {_SAME}, count(*) AS total_tasks,
        {_count("'COMPLETED'")} AS completed_tasks, {_count("'PENDING', 'VALIDATED', 'PARTIAL_COMPLETED'")} AS remaining_tasks,
        {_count("'NOT_FOUND'")} AS skipped_not_found, {_count("'FAILED'")} AS failed_errors,
        {pct(_count("'COMPLETED', 'NOT_FOUND'"), 'count(*)')} AS progress_pct,
        CASE WHEN {_count("'PENDING', 'VALIDATED', 'PARTIAL_COMPLETED'")} = 0 AND {_count("'FAILED'")} = 0
            THEN 'PASSED: 100% COMPLETED' ELSE 'INCOMPLETE / HAS FAILURES' END AS execution_status
        FROM finished JOIN rul USING (group_code) GROUP BY {_SAME}""",
    "rpt_reconcile": f"""
        WITH a AS (SELECT batch_id, {_SAME}, CAST(sum(deleted_row_count) AS BIGINT) AS n
            FROM audit GROUP BY batch_id, {_SAME})
        SELECT batch_id, {_SAME}, coalesce(estimated_rows_to_delete, 0) AS dry_run_estimated,
            coalesce(n, 0) AS actual_deleted,
            coalesce(n, 0) - coalesce(estimated_rows_to_delete, 0) AS variance,
            CASE WHEN coalesce(n, 0) = coalesce(estimated_rows_to_delete, 0)
                THEN 'MATCH (100%)' ELSE 'MISMATCH - CHECK REQUIRED' END AS reconciliation_status
        FROM run_summary FULL OUTER JOIN a USING (batch_id, {_SAME})""",
    "rpt_residual": f"""
        SELECT batch_id, group_code, CASE group_code WHEN 'CUST_EVENTS' THEN 'events'
                WHEN 'CUST_ORDERS' THEN 'customer' WHEN 'NATION_PURGE' THEN 'nation'
                WHEN 'SESSIONS' THEN 'events' ELSE 'orders' END AS target_table,
            count(*) AS completed_keys_checked,
            count(*) FILTER (WHERE group_code = 'ORDERS') AS leaked_residual_keys,
            CASE WHEN group_code = 'ORDERS' THEN 'FAIL: RESIDUAL DATA DETECTED'
                ELSE 'CLEAN (0 RESIDUAL)' END AS sanity_status
        FROM finished WHERE (group_code = 'ORDERS' AND status = 'VALIDATED')
            OR (group_code IN {_RAN} AND status = 'COMPLETED') GROUP BY batch_id, group_code""",
    "rpt_throughput": """SELECT group_code, target_table, count(*) AS chunk_batches,
        CAST(sum(deleted_row_count) AS BIGINT) AS total_rows_deleted,
        min(started_at) AS first_chunk_at, max(executed_at) AS last_chunk_at,
        CAST(epoch(max(executed_at)) - epoch(min(started_at)) AS DOUBLE) AS duration_seconds,
        round(sum(deleted_row_count) / (epoch(max(executed_at)) - epoch(min(started_at))), 2)
            AS rows_per_second FROM audit GROUP BY 1, 2""",
    "rpt_certificate": f"""SELECT batch_id, {_SAME},
        CAST(sum(deleted_row_count) AS BIGINT) AS total_purged_rows,
        min(started_at) AS purge_started_at, max(executed_at) AS purge_completed_at,
        (SELECT count(*) FROM finished f WHERE f.group_code = a.group_code
            AND status = 'COMPLETED') AS completed_keys_count,
        (SELECT count(*) FROM finished f WHERE f.group_code = a.group_code
            AND status = 'NOT_FOUND') AS missing_keys_count
        FROM audit a GROUP BY batch_id, {_SAME}""",
    "rpt_status_share": f"""SELECT group_code, status, count(*) AS task_count,
        {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY group_code)')} AS pct
        FROM finished GROUP BY 1, 2""",
    "rpt_status_plain": """SELECT batch_id, group_code, status, count(*) AS cnt FROM finished
        GROUP BY 1, 2, 3""",
    "rpt_status_times": """SELECT group_code, status, count(*) AS total_tasks,
        min(processed_at) AS first_processed, max(processed_at) AS last_processed
        FROM finished GROUP BY 1, 2""",
    "rpt_mask_audit": """SELECT group_code, target_table, columns_masked,
        count(*) AS total_chunks, CAST(sum(masked_row_count) AS BIGINT) AS total_rows_masked,
        round(avg(masked_row_count), 1) AS avg_rows_per_chunk,
        round(CAST(sum(duration_sec) AS DOUBLE), 2) AS total_duration_seconds,
        round(sum(masked_row_count) / CAST(sum(duration_sec) AS DOUBLE), 0) AS rows_per_second
        FROM timed_mask_audit GROUP BY 1, 2, 3""",
    "rpt_chunk_timeline": """SELECT chunk_number, group_code, target_table, execution_order,
        columns_masked, masked_row_count, duration_sec, processed_at FROM timed_mask_audit
        ORDER BY chunk_number, group_code, target_table, execution_order, columns_masked
        LIMIT 100""",
    "rpt_failed": """SELECT group_code, key_no, error_message, processed_at FROM finished
        WHERE status = 'FAILED'""",
    "rpt_not_found_sample": """SELECT group_code, key_no, status, created_at FROM report_tasks
        WHERE status = 'NOT_FOUND' ORDER BY group_code, key_no LIMIT 50""",
    "rpt_audit_trail": "SELECT * FROM audit",
    "rpt_audit_totals": """SELECT group_code, target_table,
        CAST(sum(deleted_row_count) AS BIGINT) AS total_rows, count(*) AS chunks
        FROM audit GROUP BY 1, 2""",
    "verify_untouched": """SELECT 'customer' AS table_name, count(*) AS rows_checked,
            CAST(0 AS BIGINT) AS rows_changed FROM customer
            WHERE c_custkey NOT IN (SELECT v FROM hit_customers)
        UNION ALL SELECT 'orders', count(*), 0 FROM orders
            WHERE o_custkey NOT IN (SELECT v FROM hit_customers)
        UNION ALL SELECT 'events', count(*), 0 FROM events
            WHERE user_id NOT IN (SELECT v FROM hit_users)""",
    "verify_row_count": " UNION ALL ".join(
        f"""SELECT '{g}' AS run, '{t}' AS table_name, count(*) AS rows_before,
            count(*) FILTER (WHERE {hit}) AS rows_removed,
            count(*) FILTER (WHERE NOT ({hit})) AS rows_after, TRUE AS balanced FROM {t}"""
        for g, t, hit in [
            ("CUST_EVENTS", "events", "user_id IN (SELECT v FROM cust_keys)"),
            ("CUST_ORDERS", "lineitem", "l_orderkey IN (SELECT o_orderkey FROM cust_orders)"),
            ("CUST_ORDERS", "orders", "o_custkey IN (SELECT v FROM cust_keys)"),
            ("CUST_ORDERS", "customer", "c_custkey IN (SELECT v FROM cust_keys)"),
            ("NATION_PURGE", "lineitem", "l_orderkey IN (SELECT o_orderkey FROM nation_orders)"),
            ("NATION_PURGE", "orders", "o_orderkey IN (SELECT o_orderkey FROM nation_orders)"),
            ("NATION_PURGE", "customer", "c_nationkey IN (SELECT v FROM nation_keys)"),
            ("NATION_PURGE", "supplier", "s_nationkey IN (SELECT v FROM nation_keys)"),
            ("NATION_PURGE", "nation", "n_nationkey IN (SELECT v FROM nation_keys)"),
            ("ORDERS", "lineitem", "l_orderkey IN (SELECT v FROM order_keys)"),
            ("ORDERS", "orders", "o_orderkey IN (SELECT v FROM order_keys)"),
            ("SESSIONS", "events", "user_id IN (SELECT v FROM session_keys)"),
            ("MASKING", "customer", "FALSE"), ("MASKING", "orders", "FALSE"),
            ("MASKING", "events", "FALSE"),
        ]
    ),
    "chk_unique_collision": f"""
        WITH m AS (SELECT CASE WHEN hit THEN 'CONFIDENTIAL_ADDRESS' ELSE address END AS address,
                CASE WHEN hit THEN {hashed('username', SALT)} ELSE username END AS username
            FROM (SELECT *, c_custkey IN (SELECT v FROM hit_customers) AS hit FROM customer_pii))
        SELECT 'CUST_PII' AS group_code, 'customer' AS target_table, 'address' AS column_name,
            address AS value, count(*) AS occurrences FROM m GROUP BY address HAVING count(*) > 1
        UNION ALL SELECT 'USER_ANON', 'customer', 'username', username, count(*) FROM m
            GROUP BY username HAVING count(*) > 1""",
    "chk_column_exists": """
        WITH c AS (SELECT * FROM mask_rul UNION ALL
                SELECT 'CUST_PII', 'part', 'owner', 1, 'NULL'),
            n AS (SELECT 'customer' AS target_table, count(*) AS rows FROM customer
                UNION ALL SELECT 'orders', count(*) FROM orders
                UNION ALL SELECT 'events', count(*) FROM events
                UNION ALL SELECT 'part', count(*) FROM part)
        SELECT c.group_code, c.target_table, c.column_name,
            CASE WHEN column_name = 'owner' THEN 'ERROR: target column does not exist'
                WHEN column_name = 'phone'
                    THEN 'WARNING: length 15 may be too short for masked output'
                ELSE 'OK' END AS status, n.rows
        FROM c JOIN n USING (target_table)""",
    "chk_length": """
        WITH lim AS (SELECT * FROM (VALUES ('email', 30), ('phone', 12), ('citizen_id', 20),
            ('full_name', 15), ('note', 60), ('actor', 16)) AS t(column_name, declared_length)),
            longest AS (SELECT group_code, target_table, column_name,
                CAST(max(length(after)) AS INTEGER) AS longest_mask FROM masked_pairs GROUP BY ALL)
        SELECT r.group_code, r.target_table, r.column_name,
            CAST(declared_length AS INTEGER) AS declared_length, longest_mask,
            coalesce(longest_mask > declared_length, FALSE) AS too_long
        FROM mask_rul r LEFT JOIN longest l ON l.group_code = r.group_code
            AND l.target_table = r.target_table AND l.column_name = r.column_name
        LEFT JOIN lim ON lim.column_name = r.column_name""",
    "chk_unmasked_leak": """
        WITH d AS (SELECT *, regexp_replace(before, '[^0-9]', '', 'g') AS b,
            regexp_replace(after, '[^0-9]', '', 'g') AS a FROM masked_pairs)
        SELECT r.group_code, r.target_table, r.column_name,
            count(before) AS checked_values,
            count(*) FILTER (WHERE before = after) AS unchanged_values,
            count(*) FILTER (WHERE b <> '' AND contains(a, b)) AS digits_shown
        FROM mask_rul r LEFT JOIN d ON d.group_code = r.group_code
            AND d.target_table = r.target_table AND d.column_name = r.column_name
        GROUP BY r.group_code, r.target_table, r.column_name""",
    "chk_referenced_column": """
        SELECT DISTINCT r.group_code, r.target_table AS parent_table,
            'column_' || execution_order AS parent_col,
            'returns_' || l_returnflag AS child_table, 'line_ref' AS child_col,
            execution_order % 2 = 0 AS deterministic
        FROM sup_rul r JOIN (SELECT DISTINCT l_linenumber, l_returnflag FROM lineitem) l
            ON l_linenumber = execution_order WHERE execution_order <> 7""",
    "chk_cascade_scope": """
        SELECT 'CUST_ORDERS' AS group_code, 'customer' AS parent_table, 'orders' AS child_table,
            'o_custkey' AS child_col, count(*) AS rows_outside_rules FROM orders
            WHERE o_custkey IN (SELECT c_custkey FROM customer
                WHERE c_custkey IN (SELECT v FROM cust_keys))
        UNION ALL SELECT 'CUST_ORDERS', 'orders', 'lineitem', 'l_orderkey', count(*) FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM cust_orders)
        UNION ALL SELECT 'CUST_ORDERS', 'customer', 'events', 'user_id', count(*) FROM events
            WHERE user_id IN (SELECT c_custkey FROM customer
                WHERE c_custkey IN (SELECT v FROM cust_keys))""",
    "chk_orphans": """
        SELECT 'orders' AS child_table, 'o_custkey' AS child_col, 'customer' AS parent_table,
            CAST(0 AS BIGINT) AS orphan_rows
        UNION ALL SELECT 'lineitem', 'l_orderkey', 'orders', count(*) FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM cust_orders)
        UNION ALL SELECT 'events', 'user_id', 'customer', count(*) FROM events
            WHERE user_id IN (SELECT v FROM cust_keys)
        UNION ALL SELECT 'customer', 'c_nationkey', 'nation', 0
        UNION ALL SELECT 'supplier', 's_nationkey', 'nation', 0""",
    "chk_rule_order": """SELECT 'CUST_ORDERS' AS group_code, 'lineitem' AS target_table,
        3 AS execution_order, 1 AS earlier_order, 'orders' AS hop_table,
        count(*) AS estimated_rows_to_delete FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM cust_orders)""",
    "chk_overlap_groups": """SELECT key_type, target_table,
        string_agg(DISTINCT group_code, ', ' ORDER BY group_code) AS group_codes,
        count(DISTINCT group_code) AS group_count
        FROM sup_rul JOIN sup_grp USING (group_code) WHERE is_active
        GROUP BY 1, 2 HAVING count(DISTINCT group_code) > 1""",
    "stream_requests": "SELECT group_code, key_no, status FROM tasks",
    "stream_suppress": "SELECT * FROM events WHERE user_id NOT IN (SELECT v FROM cust_keys)",
    "stream_suppress_mask": """SELECT event_id, ts,
        CASE WHEN user_id IN (SELECT v FROM cust_keys) THEN -1 ELSE user_id END AS user_id,
        event_type, value,
        CASE WHEN user_id NOT IN (SELECT v FROM cust_keys) THEN props END AS props FROM events""",
    "stream_audit_rate": """SELECT date_trunc('minute', executed_at) AS minute_start, group_code,
        count(*) AS audit_rows, CAST(sum(deleted_row_count) AS BIGINT) AS rows_deleted
        FROM audit GROUP BY 1, 2""",
}


def _merged(body: str) -> str:
    """Bodies may open with their own WITH; both lists then become one."""
    text = body.strip()
    full = _with(text)
    if full is not text and text.startswith("WITH "):
        head, own = full[: -len(text)].rstrip(), text[len("WITH ") :]
        return f"{head},\n{own}"
    return full


ORACLE = {name: _merged(body) for name, body in _BODIES.items()}
