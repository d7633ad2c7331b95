"""Rows that tests are built from."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

AS_OF = datetime(2026, 8, 14, 12, tzinfo=timezone.utc)


def article(**changes) -> dict:
    row = {
        "article_id": "row-1", "title": "Harbour town drafts CSRD carbon report",
        "url": "https://harbour.example/n/41", "canonical_url": "https://harbour.example/n/41",
        "summary": "Ferries count their climate emissions for the first time.", "author": None,
        "published_at": (AS_OF - timedelta(days=1)).isoformat(), "published_raw": None,
        "categories": [], "source_id": "harbour", "source_name": "Harbour Post", "source_market": "EU",
        "source_type": "media", "language": "en", "feed_url": "https://harbour.example/feed.xml",
        "fetched_at": AS_OF.isoformat(),
    }
    row.update(changes)
    return row
