"""Column -> Column helpers; all native Spark expressions except where noted."""
