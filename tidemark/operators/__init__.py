"""Relational building blocks: latest row per key, lookup joins, upserts, checks, CDC parsing."""
