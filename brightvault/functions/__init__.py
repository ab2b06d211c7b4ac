"""The functions of the warehouse."""
