"""DataFrame operators: normalise, register, catalogue, match and read."""
