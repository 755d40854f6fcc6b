"""guestfold: customer-data consolidation as plain Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or
``Column -> Column``) built from Spark SQL expressions, windows and joins so
that Catalyst plans it and whole-stage codegen runs it.  Nothing pulls row
data to the driver.
"""

__version__ = "0.1.0"
