"""tallyforge: a Spark-first engine for event results and other multi-source records."""
