"""Reading and writing corpora, manifests, metadata, listings and feature tables."""
