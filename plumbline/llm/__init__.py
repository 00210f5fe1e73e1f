"""Training-data corpus operators."""
