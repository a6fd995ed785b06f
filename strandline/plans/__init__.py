"""Query plans: fixtures, the query registry and the oracle SQL."""
