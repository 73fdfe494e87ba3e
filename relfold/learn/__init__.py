"""Spark ML jobs on feature tables: boosted trees, cross-validation, term counts, topics and factors."""
