"""Jobs that chain operators and write each stage's tables."""
