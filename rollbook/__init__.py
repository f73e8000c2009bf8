"""Inventory-change analytics on Spark DataFrames."""
