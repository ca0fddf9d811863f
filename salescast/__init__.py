"""salescast: sales analytics and forecasting as Spark DataFrame jobs.

Layout
  schemas      pinned StructTypes and table names (A10)
  session      SparkSession helpers (checkpoint dir, size-bounded broadcast)
  sources/     driver-table bridge, nested/flat readers, sinks (A1-A12)
  functions/   column-expression helpers (money, dates, arrays, metrics)
  operators/   flatten, load, marts, series, backtest, regression, quality, ...
  plans/       composed user-callable runs (load, marts, forecast, serve, intraday)
  streaming/   Structured Streaming bronze + today-so-far jobs
"""

__all__ = ["schemas", "session"]
