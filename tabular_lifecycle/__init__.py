"""Tabular model-lifecycle analytics written as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` with keyword options. Sub-packages:

* ``sources``   declared-schema CSV, tables, Parquet, run logs
* ``sinks``     overwrite / append / merge writes and catalog life cycle
* ``functions`` column expressions (cleaning, casts, hashing)
* ``operators`` relational, profiling, sampling, features, models, evaluation, drift
* ``plans``     census preparation, dashboard queries, the composed lifecycle
* ``registry``  the named queries and their SQL equivalents used for checking
"""
