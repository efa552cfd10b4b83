"""accesslake.functions."""
