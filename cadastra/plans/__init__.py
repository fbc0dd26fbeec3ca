"""Named queries over the provided tables."""
