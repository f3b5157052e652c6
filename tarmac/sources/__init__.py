"""Readers and the flight-shaped view over the provided test tables."""
