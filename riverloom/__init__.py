"""River-corridor analytics on Spark: prepare, link, replace and serve corridor data."""
