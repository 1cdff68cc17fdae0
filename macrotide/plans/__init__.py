"""Layers of the lakehouse composed from the operators."""
