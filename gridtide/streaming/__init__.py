"""Requests that keep arriving."""
