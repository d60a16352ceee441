"""Column expressions: spectral indices, soil loss, classes, rules, tails of distributions, coordinates."""
