"""DataFrame operators on the candle relation."""
