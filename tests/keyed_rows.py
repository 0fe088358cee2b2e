"""Rows looked up by key."""

from __future__ import annotations


def by_key(df, key):
    """Rows as dictionaries, by key; a repeated key fails."""
    rows = [r.asDict() for r in df.collect()]
    keyed = {r[key]: r for r in rows}
    assert len(keyed) == len(rows)
    return keyed
