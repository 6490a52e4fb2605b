"""Business data integration on Spark DataFrames.

``functions``  column expressions
``operators``  DataFrame to DataFrame building blocks (merge, lookup, keys, trees, nesting)
``sources``    declared schemas, extracts, full-refresh loads, document outbox
``plans``      whole jobs built from the operators
``streaming``  polling for changes as a stream
``catalog``    every operator and job, bound to the driver's tables with its SQL oracle
"""
