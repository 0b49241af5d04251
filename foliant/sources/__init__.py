"""Readers of document formats, archives and manifests."""
