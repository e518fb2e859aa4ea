"""Retail-bill analytics on Spark: plain ``DataFrame -> DataFrame`` operators."""
