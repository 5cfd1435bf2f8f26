"""Survey and registry microdata to map-ready statistics, as Spark DataFrame jobs."""

from mapstrata.plans.long_scale import LongScale
from mapstrata.plans.prepare import Preparation, run_preparation
from mapstrata.plans.strata import Stratifier, run_stratification

__all__ = ["LongScale", "Preparation", "Stratifier", "run_preparation", "run_stratification"]
