"""Log-anomaly analytics as Spark DataFrame plans."""
