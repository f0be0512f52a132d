"""Collection builds, views and named queries, composed from the operators."""
