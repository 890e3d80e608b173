from clientlens.ml.features import (  # noqa: F401
    Preparation, dictionary, dictionary_index, feature_pipeline, fit_preparation, hash_bucket, hash_split, slot_names, split_column,
    string_indexer,
)
from clientlens.ml.metrics import (  # noqa: F401
    binary_metrics, class_metrics, confusion_matrix, per_class,
)
from clientlens.ml.models import (  # noqa: F401
    TunedModel, auc_evaluator, auc_roc, feature_importance, grid_results, layout, random_forest, score, train_rf,
    tree_partitions, tune_rf,
)
