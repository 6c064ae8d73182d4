"""Training-data operators: one module per operator, and ``queries`` with what is registered."""
