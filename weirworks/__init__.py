"""Stream-analytics operators as plain PySpark DataFrame transformations."""
