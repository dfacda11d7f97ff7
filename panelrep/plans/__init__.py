"""Indicator recipes, the report assembly, and the stand-in project."""
