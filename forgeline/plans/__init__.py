"""Physical-plan helpers: join strategy with a size check, skew-proof
ordering of rows within a group, and plan inspection for tests."""
