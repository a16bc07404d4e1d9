"""Scalar functions: text, identifiers, costs, fuzzy comparison, XML."""
