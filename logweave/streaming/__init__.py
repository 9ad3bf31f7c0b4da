"""The stateless parsers on streaming sources, and running per-user totals."""
