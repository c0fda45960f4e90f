"""Product analytics on event logs, written as Spark DataFrame transformations.

``functions``  column expressions
``sources``    readers, writers, scratch tables
``operators``  DataFrame -> DataFrame transformations, lazy unless stated
``plans``      multi-step jobs that read and write table layers
"""

__version__ = "0.1.0"
