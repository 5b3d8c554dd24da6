"""End-to-end queries put together from the operators."""
