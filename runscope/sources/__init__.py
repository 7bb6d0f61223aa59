"""Where runs come from and where results go."""
