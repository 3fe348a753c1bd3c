"""Column-expression functions: cleaning, calendar, metrics, routing."""
