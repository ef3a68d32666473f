"""Reading, writing and sharing tables."""
