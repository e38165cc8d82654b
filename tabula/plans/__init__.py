"""Analog entities, recipes, the query catalog and the end-to-end pipeline."""
