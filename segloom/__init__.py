"""Spatial enrichment of road-network segments as PySpark DataFrame operators."""
