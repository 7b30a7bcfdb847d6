"""Readers for the five source files and for the benchmark tables."""
