"""Daily reports over pre-aggregated tables, as plain PySpark DataFrame code.

``functions``  column helpers (ratios, money, words)
``operators``  DataFrame in, DataFrame out (slices, joins, first/last state, word split)
``sources``    table schemas, table lifecycle, storage partitioned by day
``plans``      rollups built from raw rows, and the reports over them
"""
