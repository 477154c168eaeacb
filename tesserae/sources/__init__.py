"""Readers, writers and bindings of input tables."""
