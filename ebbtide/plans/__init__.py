"""The operators put together: training table, model preparation, scoring and monitoring."""
