"""Whole jobs: vault building and storage, analytics, the load pipeline and its reports."""
