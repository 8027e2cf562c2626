"""Used-vehicle analytics as Spark DataFrame operators."""
