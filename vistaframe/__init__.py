"""vistaframe: analytical operators expressed as Spark DataFrame plans.

Every public operator is a plain function ``DataFrame(s) + column names +
options -> DataFrame``. Nothing collects rows to the driver; parameters
only shape the logical plan, which Catalyst then optimises.
"""

__version__ = "0.1.0"
