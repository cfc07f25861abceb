"""Training-data operators: one module for each, and ``queries`` that applies them to whole tables."""
