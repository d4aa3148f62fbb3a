"""Reports, exploration and dashboard queries."""
