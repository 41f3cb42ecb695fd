"""Table-level helpers: joins, nesting, ranking, data-quality checks."""
