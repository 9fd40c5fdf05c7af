"""Column functions: months, text, codes and request outcomes."""
