"""Small frames and their rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def bag(df) -> Counter:
    return Counter(rows(df))


def by_key(df, key: str) -> dict:
    out = {}
    for row in df.collect():
        assert row[key] not in out, f"two rows for {row[key]}"
        out[row[key]] = row.asDict()
    return out
