"""Query plans: named queries, their SQL oracles and whole jobs."""
