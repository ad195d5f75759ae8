"""Layered invoice analytics on Spark: bronze, silver and gold as DataFrame operators."""
