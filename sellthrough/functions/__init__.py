from sellthrough.functions.text import (
    WHITESPACE, file_label, load_id, money_text, normal_header, standard_header, standard_name, strip_text,
)
from sellthrough.functions.values import parse_count, parse_date, parse_money, round_count, round_money
from sellthrough.functions.weeks import (
    checked_week_range, is_week_end, last_completed_week, month_name, week_ending, week_range, week_starting, weeks_ago,
)

__all__ = [
    "WHITESPACE", "checked_week_range", "file_label", "is_week_end", "last_completed_week", "load_id", "money_text",
    "month_name", "normal_header", "parse_count", "parse_date", "parse_money", "round_count", "round_money",
    "standard_header", "standard_name", "strip_text", "week_ending", "week_range", "week_starting", "weeks_ago",
]
