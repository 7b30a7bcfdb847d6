"""Batch operators: cleaning, reject records, hubs, satellites, links."""
