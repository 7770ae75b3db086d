"""The registered queries: operators on the given tables, and the same results in plain SQL."""
