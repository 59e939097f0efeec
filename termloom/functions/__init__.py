"""Column expressions: page parsing, tokenising and posting coding."""
