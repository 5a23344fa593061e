"""Data operators: profiling, preprocessing, grouping, folds, models, blending."""
