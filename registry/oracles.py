"""The SQL twin of each query, in DuckDB's dialect, written from the raw tables.

Where a query goes through a rollup, its twin says the same in one step where that is possible;
user counts are added up over days, as the rollups define them.
"""

from __future__ import annotations

# Half-up rounding to two places of a ratio of whole numbers; a cast of the ratio can differ on a
# tie.
def _2dp(a: str, b: str) -> str:
    return f"CAST(((200 * {a} + {b}) // (2 * NULLIF({b}, 0))) * 0.01 AS DECIMAL(16,2))"


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _funnel(where: str) -> str:
    names = {
        "home_count": "view",
        "course_detail_count": "click",
        "cart_add_count": "signup",
        "order_count": "purchase",
        "pay_success_count": "error",
    }
    sums = ", ".join(
        f"{_big(f'SUM(CASE WHEN event_type = {v!r} THEN 1 ELSE 0 END)')} AS {c}"
        for c, v in names.items()
    )
    return f"SELECT {sums} FROM events {where}"


def _review(where: str) -> str:
    return f"""
        SELECT course_id, course_name, {_2dp(_big('SUM(stars)'), _big('SUM(users)'))} AS avg_stars,
               {_big('SUM(users)')} AS uv, {_2dp(_big('SUM(star5)'), _big('SUM(users)'))} AS star5_rate
        FROM (SELECT CAST(l_shipdate AS DATE) AS dt, l_partkey AS course_id, p_name AS course_name,
                     {_big('SUM(l_orderkey % 5 + 1)')} AS stars, COUNT(DISTINCT l_suppkey) AS users,
                     {_big('SUM(CASE WHEN l_orderkey % 5 = 4 THEN 1 ELSE 0 END)')} AS star5
              FROM lineitem LEFT JOIN part ON l_partkey = p_partkey {where}
              GROUP BY 1, 2, 3)
        GROUP BY 1, 2"""


def _region(where: str) -> str:
    return f"""
        SELECT n_name AS province_name, CAST(SUM(amount) AS DECIMAL(38,2)) AS final_amount,
               {_big('SUM(users)')} AS uv, {_big('SUM(orders)')} AS vv
        FROM (SELECT CAST(o_orderdate AS DATE) AS dt, n_name,
                     SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount,
                     COUNT(DISTINCT o_custkey) AS users, COUNT(*) AS orders
              FROM orders LEFT JOIN customer ON o_custkey = c_custkey
                          LEFT JOIN nation ON c_nationkey = n_nationkey {where}
              GROUP BY 1, 2)
        GROUP BY n_name"""


def _by_date(where: str) -> str:
    return f"""
        SELECT CAST(o_orderdate AS DATE) AS biz_date,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS final_amount,
               COUNT(DISTINCT o_custkey) AS uv, COUNT(*) AS vv
        FROM orders {where} GROUP BY 1"""


def _exam(key: str, name: str, out: str, label: str, where: str) -> str:
    return f"""
        SELECT {key} AS {out}, {name} AS {label}, {_big('SUM(users)')} AS uv,
               SUM(score) / NULLIF(SUM(views), 0) AS avg_score,
               {_big('TRUNC(SUM(duration) / NULLIF(SUM(views), 0))')} AS avg_duration_sec
        FROM (SELECT CAST(l_shipdate AS DATE) AS dt, {key}, {name},
                     COUNT(DISTINCT l_orderkey) AS users, COUNT(*) AS views,
                     {_big('SUM(l_quantity)')} AS score, {_big('SUM(l_orderkey)')} AS duration
              FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
                            LEFT JOIN (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name
                                  FROM nation) ON s_nationkey = n_nationkey {where}
              GROUP BY 1, 2, 3)
        GROUP BY 1, 2"""


def _distribution(where: str) -> str:
    low = _big("FLOOR((l_quantity - 1) / 10) * 10 + 1")
    return f"""
        SELECT l_suppkey AS paper_id, s_name AS paper_title,
               CAST(low AS VARCHAR) || '-' || CAST(low + 9 AS VARCHAR) AS score_range,
               {_big('SUM(users)')} AS uv
        FROM (SELECT CAST(l_shipdate AS DATE) AS dt, l_suppkey, s_name, {low} AS low,
                     COUNT(DISTINCT l_orderkey) AS users
              FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey {where}
              GROUP BY 1, 2, 3, 4)
        GROUP BY 1, 2, 3"""


def _answers(where: str) -> str:
    return f"""
        SELECT l_partkey AS question_id, p_name AS question_txt,
               {_big('SUM(correct)')} AS correct_count, {_big('SUM(answers)')} AS "count",
               SUM(correct) / NULLIF(SUM(answers), 0) AS correct_rate,
               {_big('SUM(correct_users)')} AS correct_uu_count,
               {_big('SUM(users)')} AS uu_count,
               SUM(correct_users) / NULLIF(SUM(users), 0) AS correct_uu_rate
        FROM (SELECT CAST(l_shipdate AS DATE) AS dt, l_partkey, p_name,
                     SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS correct,
                     COUNT(*) AS answers,
                     COUNT(DISTINCT CASE WHEN l_returnflag = 'N' THEN o_custkey END)
                         AS correct_users,
                     COUNT(DISTINCT o_custkey) AS users
              FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
                            LEFT JOIN part ON l_partkey = p_partkey {where}
              GROUP BY 1, 2, 3)
        GROUP BY 1, 2"""


def _first_last(table: str, key: str, time: str, state: str) -> str:
    # The states at either end as lists, unnested after the ids are grouped; ids and times of NULL
    # hold one NULL in each list.
    return f"""
        WITH ends AS (
          SELECT {key} AS id, {time} AS moment, {state} AS held,
                 MIN({time}) OVER w AS low, MAX({time}) OVER w AS high
          FROM {table} WINDOW w AS (PARTITION BY {key})),
        lists AS (
          SELECT id, low, high,
                 CASE WHEN id IS NULL OR low IS NULL THEN [NULL]
                      ELSE list(held) FILTER (WHERE moment = low) END AS early,
                 CASE WHEN id IS NULL OR low IS NULL THEN [NULL]
                      ELSE list(held) FILTER (WHERE moment = high) END AS late
          FROM ends GROUP BY id, low, high),
        opened AS (SELECT id, low, high, UNNEST(early) AS start_state, late FROM lists)
        SELECT id AS {key}, low AS start_time, start_state, high AS end_time,
               UNNEST(late) AS end_state FROM opened"""


def _per_supplier(expression: str) -> str:
    return f"""
        SELECT l_suppkey, {expression} AS quantity_per_return
        FROM (SELECT l_suppkey, {_big('SUM(l_quantity)')} AS a,
                     {_big("SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)")} AS b
              FROM lineitem GROUP BY l_suppkey)"""


WORD_LIST = r"UNNEST(regexp_extract_all(LOWER(text), '[\p{L}\p{N}]+'))"
DOCUMENT_WORDS = f"SELECT doc_id, {WORD_LIST} AS keyword FROM documents"
SHIPPED = "WHERE CAST(l_shipdate AS DATE) = DATE '1997-03-15'"
ORDERED = "WHERE CAST(o_orderdate AS DATE) = DATE '1997-03-15'"
RANGE = (
    "WHERE CAST(o_orderdate AS DATE) BETWEEN CAST(DATE '1997-03-15' - 3 AS DATE) "
    "AND DATE '1997-03-15'"
)
LEFT_JOIN = """
        SELECT o_orderkey, o_orderdate, l_orderkey, l_shipdate, l_quantity
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND o_orderdate = l_shipdate"""
EVENT_DAY = "WHERE CAST(ts AS DATE) = DATE '2024-01-16'"
PAPER = ("l_suppkey", "s_name", "paper_id", "paper_title")
COURSE = ("n_nationkey", "n_name", "course_id", "course_name")

_PART_NAME_WORDS = """
    WITH dictionary AS (SELECT DISTINCT UNNEST(string_split(p_name, ' ')) AS word FROM part),
    texts AS (SELECT p_partkey, REPLACE(p_name, ' ', '') AS name FROM part),
    places AS (SELECT p_partkey, name, UNNEST(range(1, LENGTH(name) + 1)) AS position
               FROM texts)
    SELECT p_partkey, position, word FROM places JOIN dictionary
      ON SUBSTR(name, position, LENGTH(word)) = word"""

ORACLES: dict[str, str] = {
    "keyword_totals": f"""
        SELECT keyword, COUNT(*) AS keyword_count FROM ({DOCUMENT_WORDS}) GROUP BY 1""",
    "keyword_totals_day": f"""
        SELECT keyword, COUNT(*) AS keyword_count
        FROM (SELECT UNNEST(regexp_extract_all(LOWER(props), '[\\p{{L}}\\p{{N}}]+')) AS keyword
              FROM events {EVENT_DAY}) GROUP BY 1""",
    "funnel_totals": _funnel(""),
    "funnel_totals_day": _funnel(EVENT_DAY),
    "funnel_totals_stored": _funnel(EVENT_DAY),
    "review_scores": _review(""),
    "review_scores_day": _review(SHIPPED),
    "totals_by_region": _region(""),
    "totals_by_region_day": _region(ORDERED),
    "totals_by_date": _by_date(""),
    "totals_by_date_range": _by_date(RANGE),
    "exam_by_paper": _exam(*PAPER, ""),
    "exam_by_paper_day": _exam(*PAPER, SHIPPED),
    "exam_by_course": _exam(*COURSE, ""),
    "exam_by_course_day": _exam(*COURSE, SHIPPED),
    "score_distribution": _distribution(""),
    "score_distribution_day": _distribution(SHIPPED),
    "answer_rates": _answers(""),
    "answer_rates_day": _answers(SHIPPED),
    "first_last_state": _first_last("orders", "o_custkey", "o_orderdate", "o_orderstatus"),
    "first_last_state_events": _first_last("events", "user_id", "ts", "event_type"),
    "split_words": DOCUMENT_WORDS,
    "register_split_words": DOCUMENT_WORDS,
    "split_words_dict": _PART_NAME_WORDS,
    "register_split_words_dict": f"SELECT p_partkey, CAST(position AS BIGINT) AS position, word FROM ({_PART_NAME_WORDS})",
    "split_words_dict_documents": f"""
        WITH dictionary AS (SELECT DISTINCT {WORD_LIST} AS word FROM benchmark),
        lengths AS (SELECT DISTINCT LENGTH(word) AS n FROM dictionary),
        -- a word longer than the window below fails the twin instead of going unseen
        short AS (SELECT CASE WHEN MAX(n) > 32 THEN error('word over 32 letters') ELSE 32 END AS most
                  FROM lengths),
        letters AS (SELECT doc_id, string_split(text, '') AS chars FROM documents),
        places AS (SELECT doc_id, UNNEST(chars) AS c,
                          UNNEST(range(1, LENGTH(chars) + 1)) AS position FROM letters),
        windows AS (SELECT string_agg(c, '') OVER
                             (PARTITION BY doc_id ORDER BY position
                              ROWS BETWEEN CURRENT ROW AND 31 FOLLOWING) AS w FROM places),
        pieces AS (SELECT SUBSTR(w, 1, n) AS word FROM windows, lengths, short
                   WHERE LENGTH(w) >= n AND n <= most)
        SELECT word, COUNT(*) AS places FROM pieces SEMI JOIN dictionary USING (word)
        GROUP BY word""",
    "scan_all": "SELECT * FROM lineitem",
    "scan_pruned": "SELECT l_orderkey, l_shipdate FROM lineitem",
    "partition_scan": f"SELECT *, CAST(ts AS DATE) AS dt FROM events {EVENT_DAY}",
    "table_roundtrip": """
        SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS add_time,
               o_orderstatus AS state FROM orders
        UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), '2022-01-01', '大卷手纸'),
                                        (CAST(-2 AS BIGINT), '2022-01-01', 'F'),
                                        (CAST(-2 AS BIGINT), '2022-01-02', NULL))""",
    "filter_date_between": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
        FROM orders {RANGE}""",
    "left_join_two_keys": LEFT_JOIN,
    "left_join_two_keys_hot": LEFT_JOIN,
    "min_max_by_key": """
        SELECT o_custkey, MIN(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS start_time,
               MAX(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS end_time
        FROM orders GROUP BY o_custkey""",
    "ratio_of_sums": _per_supplier("a / NULLIF(b, 0)"),
    "cast_decimal_ratio": _per_supplier(_2dp("a", "b")),
    "cast_bigint_ratio": _per_supplier(_big("TRUNC(a / NULLIF(b, 0))")),
    "additive_users_hourly_day": f"""
        SELECT event_type, {_big('SUM(uv)')} AS users_summed
        FROM (SELECT date_trunc('hour', ts) AS h, event_type, COUNT(DISTINCT user_id) AS uv
              FROM events {EVENT_DAY} GROUP BY 1, 2)
        GROUP BY event_type""",
    "additive_users": f"""
        SELECT event_type, {_big('SUM(uv)')} AS users_summed
        FROM (SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(DISTINCT user_id) AS uv
              FROM events GROUP BY 1, 2)
        GROUP BY event_type""",
}

for _name in ("keyword_totals", "review_scores", "totals_by_region", "exam_by_paper", "exam_by_course", "score_distribution", "answer_rates"):
    ORACLES[f"{_name}_stored"] = ORACLES[f"{_name}_day"]
ORACLES["totals_by_date_stored"] = ORACLES["totals_by_date_range"]

ORACLES["keyword_totals_hourly_stored"] = ORACLES["keyword_totals_day"]
ORACLES["answer_rates_hourly_stored"] = ORACLES["answer_rates_compacted_stored"] = f"""
        WITH questions AS (SELECT LENGTH(event_type) AS id, MIN(event_type) AS txt FROM events GROUP BY 1),
        hours AS (
          SELECT date_trunc('hour', ts) AS hour, LENGTH(event_type) AS id, COUNT(*) AS answers,
                 COUNT(*) FILTER (WHERE event_id % 2 = 0) AS correct, COUNT(DISTINCT user_id) AS users,
                 COUNT(DISTINCT user_id) FILTER (WHERE event_id % 2 = 0) AS correct_users
          FROM events {EVENT_DAY} GROUP BY 1, 2)
        SELECT {_big('id')} AS question_id, txt AS question_txt, {_big('SUM(correct)')} AS correct_count,
               {_big('SUM(answers)')} AS "count", SUM(correct) / NULLIF(SUM(answers), 0) AS correct_rate,
               {_big('SUM(correct_users)')} AS correct_uu_count, {_big('SUM(users)')} AS uu_count,
               SUM(correct_users) / NULLIF(SUM(users), 0) AS correct_uu_rate
        FROM hours JOIN questions USING (id) GROUP BY id, txt"""
