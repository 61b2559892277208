"""Enrich, score and audit tables of free-text records with Spark."""
