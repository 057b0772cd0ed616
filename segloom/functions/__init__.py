"""Column functions on geometries: points, lines and polygons as structs and arrays."""
