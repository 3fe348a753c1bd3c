"""Operators for preparing language-model training text, each a Spark job over ``documents``."""
