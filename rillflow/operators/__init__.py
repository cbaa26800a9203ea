"""DataFrame operators: parsing, catalog lookups, quality splits, metrics, tables."""
