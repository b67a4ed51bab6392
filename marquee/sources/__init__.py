from marquee.sources.files import read_reviews, write_table
from marquee.sources.pages import flatten_review_pages, page_status
from marquee.sources.upsert import upsert_reviews

__all__ = ["read_reviews", "write_table", "flatten_review_pages", "page_status", "upsert_reviews"]
