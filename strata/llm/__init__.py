"""Training-data operators: ten set pieces over documents and vectors, and their queries."""
