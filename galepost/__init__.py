"""Delivery and weather analytics as native Spark DataFrame operators."""
