"""Training-data operators: ten jobs on web pages, documents and token files."""
