"""Structured Streaming forms of the operators and the runner that drives them."""
