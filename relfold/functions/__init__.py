"""Column-level building blocks: scalar, row-wise and aggregate expressions."""
