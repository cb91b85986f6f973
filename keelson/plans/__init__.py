"""Named queries over the input tables and their SQL twins."""
