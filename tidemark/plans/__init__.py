"""Ready-made jobs composed from the operators."""
