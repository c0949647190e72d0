"""Review-network analytics expressed as Spark DataFrame operators."""
