"""Column-level helpers: every function takes and returns a Spark Column."""
