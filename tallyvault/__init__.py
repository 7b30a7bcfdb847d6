"""Spark batch engine: messy business files -> Data Vault tables -> analytics DataFrames."""
