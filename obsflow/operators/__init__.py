"""DataFrame -> DataFrame operators: dedup, enrichment, rules, reports, roll-ups, merge."""
