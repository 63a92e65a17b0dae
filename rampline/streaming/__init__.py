"""Sinks and the three stages that use them."""
