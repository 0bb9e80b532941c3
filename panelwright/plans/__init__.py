"""Analysis tables composed from the operators."""
