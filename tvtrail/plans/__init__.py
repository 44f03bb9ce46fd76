"""Daily jobs composed from the operators."""
