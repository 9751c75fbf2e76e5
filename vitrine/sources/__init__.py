"""Readers: batches, archives, images, maps and manifests."""
