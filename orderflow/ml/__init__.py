"""Train-only preparation, model candidates and scoring on pyspark.ml."""
