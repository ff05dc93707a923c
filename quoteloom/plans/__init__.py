"""Named queries over the driver tables, and the ingest job."""
