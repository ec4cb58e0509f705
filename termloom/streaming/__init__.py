"""Files that keep arriving, added to an index as they come."""
