"""Raw API-response ledgers on Spark: plan calls, resume them, land them, read them."""
