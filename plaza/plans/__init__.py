"""The tables and served results, composed from the operators."""
