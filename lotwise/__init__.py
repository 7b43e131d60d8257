"""Part consumption, failure and DPPM analytics as Spark DataFrame plans."""
