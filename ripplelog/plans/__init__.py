"""Catalogue, state and routing on the driver, and the named queries."""
