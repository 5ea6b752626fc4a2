"""Company-filing analytics expressed as Spark DataFrame plans."""
