"""Reading, conforming, storing and exporting tables."""
