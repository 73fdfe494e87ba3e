"""Reading, storing and mapping tables."""
