"""Training-data operators: one module per operator, their queries in ``queries``.

Nothing outside this subpackage (except the guarded entry module and the pipeline
at the repository top) imports it.
"""
