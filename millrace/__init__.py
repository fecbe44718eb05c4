"""Document distillation and corpus preparation as Spark plans."""
