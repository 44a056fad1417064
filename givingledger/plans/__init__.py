"""Complete plans assembled from the operators."""
