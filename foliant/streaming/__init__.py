"""Streaming intake."""
