"""Order-event analytics on Spark: bronze, silver, quarantine, gold, marts."""
