"""tagweave: document annotation, weak labelling and corpus processing on PySpark."""
