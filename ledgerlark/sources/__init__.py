"""Reading typed tables and writing versioned copies."""
