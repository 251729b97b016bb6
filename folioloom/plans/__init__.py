"""Named queries."""
