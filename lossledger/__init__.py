"""Credit-impairment analytics as lazy PySpark DataFrame transformations."""
