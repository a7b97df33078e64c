"""Named end-to-end queries and their wiring onto the supplied tables."""
