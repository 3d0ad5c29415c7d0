"""Operators for preparing text for language-model training, each a Spark job."""
