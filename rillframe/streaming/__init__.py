"""A file trigger for the batch steps."""
