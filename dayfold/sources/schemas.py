"""Schemas of the stored rollup tables the reports read.

Each row holds the partial sums of one short time window for one set of keys. The ``*_count``
columns of users are counted distinct within a window and are added up across windows.
Written as DDL text, which Spark takes wherever it takes a schema.
"""

from __future__ import annotations

# The column names that stored tables have. The day partition `dt` comes last.
ROLLUP_SCHEMAS: dict[str, str] = {
    "keyword": "keyword string, keyword_count bigint, dt date",
    "funnel": (
        "home_count bigint, course_detail_count bigint, cart_add_count bigint, "
        "order_count bigint, pay_success_count bigint, "
        "window_start timestamp_ntz, window_end timestamp_ntz, dt date"
    ),
    "review": (
        "course_id bigint, course_name string, review_stars bigint, uv bigint, star5 bigint, "
        "dt date"
    ),
    "region_trade": (
        "province_name string, final_amount decimal(28,2), uu_order_count bigint, "
        "order_count bigint, dt date"
    ),
    "daily_trade": "`current_date` date, final_amount decimal(28,2), uv bigint, vv bigint",
    "exam": (
        "paper_id bigint, paper_title string, course_id bigint, course_name string, "
        "paper_user_count bigint, course_user_count bigint, view_count bigint, score bigint, "
        "duration_sec bigint, dt date"
    ),
    "score_range": (
        "paper_id bigint, paper_title string, score_range string, uv bigint, dt date"
    ),
    "answer": (
        "question_id bigint, question_txt string, correct_count bigint, `count` bigint, "
        "correct_uu_count bigint, uu_count bigint, dt date"
    ),
}

#: The same tables with the ends of a window inside the day beside the sums; the funnel has them anyway.
WINDOW_SCHEMAS: dict[str, str] = {
    name: columns.replace("dt date", "window_start timestamp_ntz, window_end timestamp_ntz, dt date")
    for name, columns in ROLLUP_SCHEMAS.items()
    if columns.endswith("dt date") and "window_start" not in columns
}
