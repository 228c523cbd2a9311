"""Column builders and the registry of derived features."""
