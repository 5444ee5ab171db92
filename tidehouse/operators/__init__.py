"""Reusable DataFrame transforms."""
