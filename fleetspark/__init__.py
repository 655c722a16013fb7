"""fleetspark: fleet-wide database telemetry analytics as plain Spark DataFrame jobs.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from built-in
Spark SQL expressions; one job answers for every instance of the fleet at once.
"""

__version__ = "0.1.0"
