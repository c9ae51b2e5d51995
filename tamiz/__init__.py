"""Tabular classification on Spark: preparation, KNN and tree models, reports and scoring."""
