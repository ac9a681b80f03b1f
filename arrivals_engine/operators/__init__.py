"""DataFrame operators: cleaning, lookups and quality checks."""
