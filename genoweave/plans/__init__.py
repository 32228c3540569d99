"""Whole flows made of the operators, and the registered queries."""
