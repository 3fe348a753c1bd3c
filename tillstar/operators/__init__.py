"""Relational operators built from DataFrame primitives: joins, ids, upserts, checks,
windows, staging and profiling."""
