"""Relational operators over footprints, tiles, pixels and archives."""
