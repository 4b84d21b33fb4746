"""tillspark: receipt and log analytics as composable Spark DataFrame operators."""
