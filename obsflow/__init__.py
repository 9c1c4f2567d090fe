"""obsflow: observation analytics as composable Spark DataFrame operators.

Raw site observations and a time-stamped context series are typed,
deduplicated, enriched from a site dimension and by (zone, time slot),
checked by named rules, rolled up, and published behind a quality gate.
Every operator is a function ``DataFrame -> DataFrame`` that only builds a
logical plan; Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"
