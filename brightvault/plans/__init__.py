"""The plans of the warehouse."""
