"""Column -> Column scalar logic."""
