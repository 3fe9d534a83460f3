"""Column expressions: names, labels, values, identity and regex dialect."""
