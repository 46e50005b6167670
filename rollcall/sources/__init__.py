"""Landed tables, table writes and the star-schema stand-in for the HR source."""
