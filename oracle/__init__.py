"""DuckDB statements that state, independently, what each registered query returns."""

from __future__ import annotations


def statements() -> dict[str, str]:
    from oracle import analytics, jobs, quality
    from oracle.star import with_tables

    bodies = {**analytics.SQL, **quality.SQL, **jobs.SQL}
    return {name: with_tables(body, jobs.EXTRA) for name, body in bodies.items()}
