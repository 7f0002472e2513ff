"""tessarea: reconciled small-area estimate surfaces as Spark DataFrame plans."""
