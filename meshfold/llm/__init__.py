"""Training-data operators: ten jobs over documents and pages, one module each."""
