"""delaylake: delay analytics on Spark DataFrames.

Sub-packages
------------
sources     readers, writers, schemas and the domain views (flights, weather, ...)
functions   Column -> Column expressions (labels, clips, bands, risk brackets)
operators   DataFrame -> DataFrame operators (joins, cleaning, aggregates,
            dashboard tables, sampling, features, models, evaluation, scoring)
plans       composite jobs (ETL, dashboard) and the query registry with its
            DuckDB oracle SQL
streaming   Structured Streaming scoring into an append-only prediction log
"""

__version__ = "0.1.0"
