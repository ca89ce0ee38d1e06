"""Column functions and text primitives."""
