"""Cart add-on analytics as composable Spark DataFrame operators."""
