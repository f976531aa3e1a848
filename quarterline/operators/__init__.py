"""DataFrame transforms over the long contract panel (asset, ts, high, low, close, volume)."""
