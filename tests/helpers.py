"""Hand-written rows in and sorted rows out."""

from __future__ import annotations

from datetime import datetime


def ts(text: str | None):
    """'02 10:30' as that day and time of January 2024."""
    return None if text is None else datetime.strptime(f"2024-01-{text}", "%Y-%m-%d %H:%M")


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
