"""Jobs: plain functions from DataFrame to DataFrame."""
