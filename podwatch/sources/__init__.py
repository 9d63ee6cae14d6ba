"""Readers for the tables, the relational source and the landed API responses."""
