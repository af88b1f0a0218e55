"""The operators bound to inputs: test-table projections, the query registry and its SQL checks."""
