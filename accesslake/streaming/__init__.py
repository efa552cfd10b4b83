"""accesslake.streaming."""
