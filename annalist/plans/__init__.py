"""The query catalogue: each query with the SQL it must agree with."""
