"""Micro-batch loading of request changes."""
