"""Named queries over the shared tables and their SQL twins."""
