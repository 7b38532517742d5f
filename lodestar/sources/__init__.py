"""Reading, recognising and writing files."""
