"""Group assignment and reconciliation as composable Spark DataFrame operators."""
