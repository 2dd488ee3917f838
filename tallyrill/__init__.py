"""Spark-first operators for exploring, cleaning, joining, modelling and scoring tables."""
