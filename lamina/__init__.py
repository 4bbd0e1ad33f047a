"""lamina: a PySpark-native engine for document-layout analytics.

Operators take and return DataFrames.  The relational work is declared with the DataFrame API; the few
order-dependent folds live in grouped pandas functions.
"""
