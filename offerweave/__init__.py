"""Offer resolution and price analytics as lazy Spark plans."""
