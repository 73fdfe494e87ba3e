"""Feature blocks, one per history table, and the full feature matrix."""
