"""Reading and writing the library's tables."""
