"""Training-data operators (text, similarity, packing, sharding) on Spark.

Nothing else in the library imports this subpackage.  ``queries`` registers one
``opN_<name>`` query per operator; the corpus pipeline at the repository top is
registered with them as ``pipeline``.
"""
