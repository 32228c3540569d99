"""Genotype annotation and reshaping as Spark DataFrame transformations."""
