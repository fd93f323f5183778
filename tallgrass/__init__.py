"""Tallgrass: a Spark-first analytics and corpus-preparation library."""
