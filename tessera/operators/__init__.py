"""Operators: DataFrame -> DataFrame steps of preparation, profiling, features and models."""

from tessera.operators.clean import (
    cast_numeric,
    day_parts,
    drop_columns,
    drop_missing_target,
    filter_flag,
    filter_upper,
    null_to_unknown,
    present,
    require_columns,
    sentinel_to_null,
)
from tessera.operators.dictionary import LabelDictionary, label_dictionary, string_index_distributed
from tessera.operators.evaluate import ModelResult, evaluate, evaluate_many, model_summary
from tessera.operators.features import (
    assemble,
    build_features,
    f_scores,
    feature_count,
    l1_normalize,
    one_hot,
    select_features,
    string_index,
)
from tessera.operators.impute import impute, impute_mean, impute_median, impute_mode
from tessera.operators.join import dim_join, entity_age, gated_join
from tessera.operators.models import (
    add_fold_column,
    best_params,
    cv_table,
    estimator,
    fit_cv,
    hash_split,
    random_split,
)
from tessera.operators.moments import comoments
from tessera.operators.profile import (
    constant_columns,
    constant_from_metrics,
    corr_matrix,
    corr_target,
    distinct_groups,
    drop_collinear,
    drop_constant_columns,
    f_regression,
    group_count,
    informative_columns,
    informative_expr,
    informative_metrics,
)
from tessera.operators.surrogates import medians, modes

__all__ = [n for n in dir() if not n.startswith("_")]
