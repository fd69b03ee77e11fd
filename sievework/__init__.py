"""Evidence mining over scientific text, expressed as Spark DataFrame plans."""
