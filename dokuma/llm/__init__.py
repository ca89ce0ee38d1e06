"""Operators for large training-data collections, one module per problem. Nothing outside imports this package."""
