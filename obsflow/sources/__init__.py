"""Readers with declared schemas: JSON pages, CSV text archives, any format."""

from obsflow.sources.context_csv import context_from_texts, read_texts, split_text, typed_measures
from obsflow.sources.pages import latest_snapshot, read_pages, read_sites, sites_from_pages
from obsflow.sources.store import collection, load_table

__all__ = [
    "collection",
    "context_from_texts",
    "latest_snapshot",
    "load_table",
    "read_pages",
    "read_sites",
    "read_texts",
    "sites_from_pages",
    "split_text",
    "typed_measures",
]
