"""keelson: batch ETL and purchase-graph analytics written as plain PySpark.

Layout
------
functions/  Column expressions (no actions): vehicle cleaning, price bands.
sources/    Scans: catalog tables, SQL text, files by format, declared CSV;
            adapters that shape the driver's tables like the jobs' inputs.
sinks/      Versioned Parquet datasets and the catalog tables that point at them.
operators/  DataFrame -> DataFrame operators: data-quality metrics, merges,
            graph construction, PageRank, connected components, comparison.
plans/      Jobs (logic / output / metrics) and the runner that records run metrics.
"""

__version__ = "0.1.0"
