"""DuckDB SQL for each registered query: the independent oracle.

Column names and types match the Spark results; DuckDB's HUGEINT sums are
cast back to BIGINT.
"""

from __future__ import annotations

_WORDS = ("CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []::VARCHAR[] "
          "ELSE string_split(rtrim(text, ' '), ' ') END")

_WORDS_TABLE = f"(SELECT doc_id, unnest({_WORDS}) AS word FROM documents)"

_RUNNING = """
SELECT event_id, event_type,
       CAST(SUM(user_id) OVER (PARTITION BY event_type ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS s,
       CAST(SUM(user_id) OVER (PARTITION BY event_type ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS p,
       ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
FROM events"""

_MAPS = """(SELECT event_id, event_type, CAST(user_id AS BIGINT) % 1000 + 1 AS m, event_id % 1000 AS c,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)"""

_COMPOSED = f"""WITH RECURSIVE maps AS MATERIALIZED {_MAPS},
composed AS (
  SELECT event_id, event_type, m, c, rn FROM maps WHERE rn = 1
  UNION ALL
  SELECT e.event_id, e.event_type, p.m * e.m % 1000003 AS m, (p.c * e.m + e.c) % 1000003 AS c, e.rn
  FROM composed p JOIN maps e ON e.event_type = p.event_type AND e.rn = p.rn + 1)"""

_ARRIVALS = """
WITH scores AS (SELECT o_custkey AS id, day(o_orderdate) * 10000000 + o_orderkey % 10000000 AS arrival, o_orderkey AS subject FROM orders),
users AS (SELECT CAST(user_id AS BIGINT) AS id, day(ts) * 10000000 + event_id % 10000000 AS arrival, event_type || '-' || event_id AS name FROM events),
firsts AS (SELECT id, min(arrival) AS first FROM users GROUP BY id)
SELECT s.id, u.name, s.subject, s.arrival FROM scores s ASOF JOIN users u ON s.id = u.id AND s.arrival >= u.arrival
UNION ALL
SELECT s.id, u.name, s.subject, s.arrival FROM scores s JOIN firsts f ON s.id = f.id AND s.arrival < f.first JOIN users u ON u.id = s.id"""

ORACLES = {
    "ordered_reduce": f"{_COMPOSED} SELECT event_type, arg_max(m, rn) AS m, arg_max(c, rn) AS c FROM composed GROUP BY event_type",
    "running_reduce": f"{_COMPOSED} SELECT event_id, event_type, m, c FROM composed",
    "enrich_in_order": _ARRIVALS,
    "tokenize_words": f"SELECT doc_id, word FROM {_WORDS_TABLE}",
    "word_count": f"SELECT word, COUNT(*) AS cnt FROM {_WORDS_TABLE} GROUP BY word",
    "char_count": "SELECT char, COUNT(*) AS cnt FROM "
                  "(SELECT unnest(string_split(text, '')) AS char FROM documents) GROUP BY char",
    "filter_word_count": f"SELECT word, COUNT(*) AS cnt FROM {_WORDS_TABLE} "
                         "WHERE word <> 'the' GROUP BY word",
    "keyed_reduce": "SELECT event_type, CAST(list_reduce(list(CAST(user_id AS BIGINT) % 1000 + 1), "
                    "lambda a, b: a * b % 1000003) AS BIGINT) AS user_id FROM events GROUP BY event_type",
    "keyed_sum": "SELECT event_type, CAST(SUM(user_id) AS BIGINT) AS user_id "
                 "FROM events GROUP BY event_type",
    "connect_map": "SELECT 'String->String:' || c_name AS value FROM customer "
                   "UNION ALL SELECT 'Long->String:' || CAST(o_orderkey AS VARCHAR) AS value FROM orders",
    "side_output": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' "
                   "WHEN event_id IS NOT NULL THEN 'odd' END AS tag FROM events",
    "union_all": "SELECT user_id AS id FROM events UNION ALL SELECT o_custkey AS id FROM orders",
    "observed_count": "SELECT COUNT(*) AS counter FROM lineitem",
    "partition_local_count": "SELECT COUNT(*) AS total FROM events",
    "sql_upper": "SELECT UPPER(c_name) AS f0 FROM customer",
    "sql_group_sum": "SELECT l_returnflag AS name, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) "
                     "AS score FROM lineitem GROUP BY l_returnflag",
    "running_sum": "SELECT event_id, event_type, CAST(SUM(user_id) OVER (PARTITION BY event_type "
                   "ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) "
                   "AS running FROM events",
    "changelog_sum": f"""
WITH r AS ({_RUNNING})
SELECT event_id, 0 AS pos, '+I' AS op, event_type, s FROM r WHERE rn = 1
UNION ALL
SELECT event_id, 0 AS pos, '-U' AS op, event_type, p AS s FROM r
WHERE rn > 1 AND p IS DISTINCT FROM s
UNION ALL
SELECT event_id, 1 AS pos, '+U' AS op, event_type, s FROM r
WHERE rn > 1 AND p IS DISTINCT FROM s""",
    "changelog_insert_only": "SELECT '+I' AS op, UPPER(c_name) AS f0 FROM customer",
    "tumbling_count": "SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start, event_type, "
                      "COUNT(*) AS cnt FROM events GROUP BY 1, 2",
    "broadcast_enrich": "SELECT o.o_custkey AS id, c.c_name AS name, o.o_orderpriority AS subject, "
                        "o.o_totalprice AS score FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
    "latest_by_key": "SELECT event_type, arg_max(user_id, event_id) AS user_id "
                     "FROM events GROUP BY event_type",
    "generate_orders": "SELECT o_orderkey AS seq, upper(md5(CAST(o_orderkey AS VARCHAR))) AS id, "
                       "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 1000 AS INTEGER) "
                       "AS userId, "
                       "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 8, 7))::BIGINT % 1000 AS INTEGER) "
                       "AS money FROM orders",
    "decode_value": "SELECT doc_id, text FROM documents",
    "upsert_latest": f"SELECT word, COUNT(*) AS cnt FROM {_WORDS_TABLE} GROUP BY word",
    "fan_out": "SELECT event_id, event_type, 'all' AS output FROM events UNION ALL "
               "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS output FROM events",
    "file_sink_rolled": "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, COUNT(*) AS lines, "
                        "CAST(SUM(strlen(CAST(event_id AS VARCHAR) || ',' || event_type) + 1) AS BIGINT) AS bytes, 0::BIGINT AS files_too_large "
                        "FROM events GROUP BY 1",
    "word_one_sum": f"SELECT word, COUNT(*) AS cnt FROM {_WORDS_TABLE} GROUP BY word",
    "rich_map": "SELECT 'Long->String:' || CAST(event_id AS VARCHAR) AS value FROM events",
    "file_sink_roundtrip": "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, "
                           "CAST(event_id AS VARCHAR) || ',' || event_type AS value FROM events",
    "file_sink_clustered": "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, "
                             "CAST(event_id AS VARCHAR) || ',' || event_type AS value FROM events",
    "jdbc_roundtrip": "SELECT n_name AS name, n_regionkey AS region FROM nation",
}
