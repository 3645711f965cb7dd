"""Multi-step plans: distributed ranking, the query registry and its SQL oracle."""
