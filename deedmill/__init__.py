"""Property, deed and ownership analytics on Spark.

``functions`` holds column expressions, ``operators`` DataFrame-to-DataFrame
building blocks, ``sources`` readers and writers, ``plans`` the composed jobs,
``streaming`` the incremental ingest, and ``registry`` the queries that run the
operators over the shared test tables together with their SQL checks.
"""
