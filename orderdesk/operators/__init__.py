"""Jobs: shipping, pricing, orders, documents, contacts. Each is a function
from DataFrames and parameters to a DataFrame; no job runs an action."""
