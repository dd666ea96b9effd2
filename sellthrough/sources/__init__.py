from sellthrough.sources.csv_feed import csv_layouts, read_csv_feed
from sellthrough.sources.files import (
    cap_drops, file_week, list_feed_files, match_feeds, next_files, pending_files, unrecognised_files, whole_drops,
)
from sellthrough.sources.json_feed import (
    api_pages, flatten_pages, incomplete_feeds, json_records, page_totals, read_api_pages, read_json_feed,
)
from sellthrough.sources.metadata import active_feeds, feed_by_id, read_pipeline_config
from sellthrough.sources.reader import read_feed_files
from sellthrough.sources.workbook import decode_workbooks, read_workbook_feed

__all__ = [
    "active_feeds", "api_pages", "cap_drops", "csv_layouts", "decode_workbooks", "feed_by_id",
    "file_week", "flatten_pages", "incomplete_feeds", "json_records", "list_feed_files", "match_feeds", "next_files",
    "page_totals", "pending_files", "read_api_pages", "read_csv_feed", "read_feed_files",
    "read_json_feed", "read_pipeline_config", "read_workbook_feed", "unrecognised_files", "whole_drops",
]
