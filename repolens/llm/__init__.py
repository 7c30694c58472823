"""Training-data operators: formatting, tokens, fingerprints, duplicates,
classifiers and mixing.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is present.  Every operator takes DataFrames and
returns DataFrames, reads only the columns it names (further columns,
whatever they are called, are ignored) and treats a null text as empty.
"""
