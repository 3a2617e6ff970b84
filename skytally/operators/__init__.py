"""DataFrame to DataFrame operators, usable in batch and, where marked, on streams."""
