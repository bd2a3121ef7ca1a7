"""Training-data operators: ten text and vector operators, their queries and their SQL."""
