"""Column expressions: tile geometry and elevation encoding."""
