"""Named queries with their reference SQL."""
