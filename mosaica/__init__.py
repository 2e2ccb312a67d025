"""Spatial tissue-imaging analytics as PySpark DataFrame operators."""
