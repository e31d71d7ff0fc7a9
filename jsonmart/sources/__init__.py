"""Landing scans and sinks, the document catalog, and the star-schema binding."""
