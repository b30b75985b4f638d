"""Periodic KPI reporting and warehouse loading as Spark DataFrame operators.

``functions``  Column -> Column helpers (no Python on the row path)
``operators``  DataFrame -> DataFrame operators (latest version, overlay, merge, SCD, formulas)
``sources``    reading period files and tables, writing snapshots and versioned history
``plans``      marts, reporting views, node loads and the end-to-end KPI run built from the above
"""
