"""Whole plans: KPI queries over the star schema, and the rebuild of the mart."""
