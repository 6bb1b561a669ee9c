"""Reading documents and writing tables."""
