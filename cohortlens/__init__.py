"""Student-progress analytics as Spark DataFrame operators."""
