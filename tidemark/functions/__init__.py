"""Column functions: rounding, masking, text and vectors."""
