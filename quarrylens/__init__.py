"""Analytics over stored-procedure code bases and the business computations in them, on PySpark DataFrames."""
