"""Trip events as a stream of files into the fact table."""
