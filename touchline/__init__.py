"""Sports and transfer analytics as plain Spark DataFrame operators."""
