"""relfold: fold one-to-many history tables into one wide row per entity, on Spark."""
