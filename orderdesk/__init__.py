"""orderdesk: supply-order back-office jobs as Spark DataFrame plans.

Every job is a function ``DataFrame(s) + parameters -> DataFrame`` built
from Spark's own expressions. Vendors, suppliers, orders and documents are
columns, never Python loops, so one job handles all of them at once.
"""

__version__ = "0.1.0"
