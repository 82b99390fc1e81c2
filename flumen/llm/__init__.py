"""Training-data operators: ten corpus jobs, each a general function plus a thin registered query."""
