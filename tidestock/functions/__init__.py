"""Column expressions and one-row statistics shared by the operators."""
