"""Sports-analytics operators, plans and models for Spark."""
