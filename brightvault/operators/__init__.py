"""The operators of the warehouse."""
