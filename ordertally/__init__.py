"""Order messages to an archive and to running totals, on Spark."""
