"""Readers, writers and the company-shaped views."""
