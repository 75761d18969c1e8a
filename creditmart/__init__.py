"""Point-in-time credit mart built from Spark DataFrame operators."""
