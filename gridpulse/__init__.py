"""Signal anomaly analytics on PySpark."""
