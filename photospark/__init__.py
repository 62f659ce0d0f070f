"""Analytics over star-by-epoch brightness tables as lazy Spark DataFrame plans."""
