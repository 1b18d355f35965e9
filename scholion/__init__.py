"""Article markup, registry and fetch-log jobs on Spark."""
