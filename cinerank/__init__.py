"""cinerank — a two-stage recommender built as Spark DataFrame jobs.

Layout
------
sources/    driver tables, fixture views, sinks and model persistence
functions/  reusable column expressions (nested-list parsing, tokens, hashing,
            distributed global ranks)
operators/  the recommender operators (catalogue, interactions, kNN, recall,
            negatives, features, metrics, TF-IDF/SVD, ALS, LambdaMART)
plans/      end-to-end jobs and the registered queries with their SQL oracles
streaming/  nothing: the recommender is a batch system
"""

__all__ = ["session"]
