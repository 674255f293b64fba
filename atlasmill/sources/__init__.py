"""Readers that turn saved payloads, registries and catalogues into typed DataFrames."""
