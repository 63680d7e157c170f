"""Retail order analytics expressed as Spark DataFrame jobs.

Layers, from the bottom up:

* ``functions`` - column builders (typed casts, money, calendar, keys, scoring);
* ``operators`` - frame-to-frame building blocks (dedup, mode, tiers, history, contracts);
* ``sources``   - scans, sinks, loads and the shared workspace;
* ``plans``     - the order ETL, the star schema, the dashboards and the declared tests;
* ``catalog``   - named queries over the driver tables and their SQL counterparts.
"""
