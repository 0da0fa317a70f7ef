"""Column functions: time, geometry, masks and frame chunks."""
