"""Relational and model operators: DataFrame in, DataFrame out."""
