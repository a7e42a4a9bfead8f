"""tabforge: a Spark-native tabular feature, training and scoring pipeline.

Every public step is a lazy ``DataFrame -> DataFrame`` function. Nothing is
collected to the driver except bounded previews and scalars.
"""

from tabforge.spec import FeatureSpec

__all__ = ["FeatureSpec"]
__version__ = "0.1.0"
