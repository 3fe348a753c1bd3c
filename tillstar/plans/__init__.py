"""Query plans: the source-derived star, reports, dashboard calculations, staging and
warehouse runs, profiling and the forecast."""
