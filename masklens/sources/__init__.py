"""Readers: manifests, landed files, Bronze/Silver tables, feed pages, CSV."""
