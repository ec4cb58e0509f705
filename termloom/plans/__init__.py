"""The stored index, the registered queries and their SQL."""
