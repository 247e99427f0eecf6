"""Column-level helpers: money sums, PII masking."""
