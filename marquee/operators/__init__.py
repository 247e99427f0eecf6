"""Relational operators: CDC dedup, quality gates, SCD Type 2."""
