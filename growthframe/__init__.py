"""growthframe: marketing, commerce and subscription analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames (plus column names and an explicit
``as_of`` date where the business rule depends on "today") to a DataFrame. Nothing is
collected to the driver except tiny bounds lookups that are documented as such.
"""

from growthframe.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
