"""Feature-table storage, text and GeoJSON readers, and the ingest jobs built on them."""
