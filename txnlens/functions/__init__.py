"""Column expressions shared by batch, stream and model code."""
