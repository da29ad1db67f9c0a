"""Column builders: scalar rules shared by the operators."""
