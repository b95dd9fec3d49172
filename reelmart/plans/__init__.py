"""The six output marts, composed from the operators."""
