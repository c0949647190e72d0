"""Analytics composed from the operators."""
