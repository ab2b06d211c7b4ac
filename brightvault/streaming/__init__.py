"""Validation and landing of the event stream."""
