"""Window control, table writes and the jobs built from the operators."""
