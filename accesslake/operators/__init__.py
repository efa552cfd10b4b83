"""accesslake.operators."""
