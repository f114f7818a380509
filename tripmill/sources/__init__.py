"""Files in, tables in and out."""
