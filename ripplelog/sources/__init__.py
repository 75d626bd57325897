"""Where tables, logs and configuration come from, and where results go."""
