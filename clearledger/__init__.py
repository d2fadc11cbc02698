"""Turn messy raw banking tables into a typed, de-duplicated canonical model on Spark."""
