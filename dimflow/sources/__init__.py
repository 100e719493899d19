"""Readers and writers for the zones and the warehouse tables."""
