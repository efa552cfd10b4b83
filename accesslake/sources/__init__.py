"""accesslake.sources."""
