"""The booking pipeline, composed from the operators."""
