"""Reading, landing, writing and describing tables."""
