"""Star schema builders, publishing and reports."""
