"""Rating predictors as ``pyspark.ml`` estimators and models, and their cross-validation."""

from recspark.models.estimators import (  # noqa: F401
    KNN, NMF, SVD, Baseline, BaselineModel, CoClustering, CoClusteringModel, KNNModel, NMFModel, Normal, NormalModel, SlopeOne, SlopeOneModel, SVDModel,
)
from recspark.models.base import RatingEstimator, RatingModel, Shared, load_model  # noqa: F401
from recspark.models.validation import cross_validate, default_models  # noqa: F401
