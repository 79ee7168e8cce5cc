"""DataFrame jobs for word counting, access logs, text similarity and ratings."""
