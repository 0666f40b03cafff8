"""tablewatch: warehouse data monitoring as Spark DataFrame plans."""
