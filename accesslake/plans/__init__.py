"""accesslake.plans."""
