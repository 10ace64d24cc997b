"""Landing, conforming and keyed storage of market data."""
