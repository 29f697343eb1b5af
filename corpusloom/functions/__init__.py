"""Column builders and Arrow-batched scalar functions."""
