"""Incremental runs: append-only logs and skip-what-is-done work lists."""
