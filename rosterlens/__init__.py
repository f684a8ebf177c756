"""Directory-integrity analytics expressed as Spark DataFrame operators."""
