"""Column functions: content selection, names, stamps, tokens, weights, characters."""
