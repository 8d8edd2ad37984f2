"""Query catalogue, fixtures derived from the given tables, and oracle SQL."""
