"""Column expressions: no DataFrame, no source, no sink."""
