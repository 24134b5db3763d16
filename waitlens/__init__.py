"""Hospital-access and inequality analytics as Spark DataFrame operators."""
