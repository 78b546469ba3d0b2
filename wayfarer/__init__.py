"""wayfarer: household travel survey tables built as Spark DataFrame plans.

Sub-packages:

* ``functions`` - Column-level survey rules and NULL-safe helpers.
* ``operators`` - relational and spatial operators (zone joins, dedup, lag).
* ``sources``   - input relations (test fixtures over the star tables, zones).
* ``plans``     - table builders, the batch pipeline, query registry, oracles.
* ``streaming`` - intentionally empty: every survey table is a batch rebuild.
"""

__version__ = "0.1.0"
