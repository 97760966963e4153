"""Readers: delimited files whose headers differ, and relational tables."""
