"""Analytics over intellectual-property grant records, written as Spark DataFrame functions."""
