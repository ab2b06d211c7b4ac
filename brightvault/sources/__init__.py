"""The sources of the warehouse."""
