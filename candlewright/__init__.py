"""Candlewright: OHLCV candles, roll-ups, gaps and indicators as lazy Spark DataFrames."""
