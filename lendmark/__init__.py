"""Credit-scorecard analytics as PySpark DataFrame operators."""
