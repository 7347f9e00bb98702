"""Graph jobs over the tie table, written as joins and aggregations."""
