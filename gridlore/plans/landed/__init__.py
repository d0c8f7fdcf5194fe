"""Source modules over the given tables, found by name."""
