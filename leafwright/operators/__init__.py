"""DataFrame operators, grouped by the job they serve."""
