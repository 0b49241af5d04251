"""Registered queries over the star-schema and document tables."""
