"""DataFrame-level operators: parse, infer, pivot, encode."""
