"""Reading feeds."""

from feedloom.sources.bounds import plan_parts
from feedloom.sources.files import read_day, read_delimited, read_table
from feedloom.sources.pages import PagesMissing, check_pages, missing_pages, unwrap_pages

__all__ = [
    "PagesMissing", "check_pages", "missing_pages", "plan_parts", "read_day", "read_delimited",
    "read_table", "unwrap_pages",
]
