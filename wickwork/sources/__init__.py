"""Sources of candles: vendor payloads, planned date chunks, stored datasets and the driver tables."""
