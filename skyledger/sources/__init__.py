"""Reading delimited files and messages, landing files and tables."""
