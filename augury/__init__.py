"""augury: panels of management guidance from company filings, on Spark."""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
