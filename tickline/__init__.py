"""tickline: Spark-native analytics for exchange-futures tick data.

Layout:
  functions/  Column -> Column expressions (time, contract names, markers)
  sources/    binary tick files (Python DataSource), contract calendar,
              the tick view over the driver's ``events`` table, file exports
  operators/  DataFrame -> DataFrame operators (cleaning, bars, rollover,
              quality reports, the opening-range study)
  plans/      multi-step jobs (ingestion, table maintenance, the study run)
              and the registered query catalog
  streaming/  Structured Streaming ingestion, de-duplication and bars
"""

from tickline.context import get_spark, workspace  # noqa: F401
