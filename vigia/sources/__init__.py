"""Reading, writing and landing of files and tables."""
