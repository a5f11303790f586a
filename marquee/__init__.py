"""Box-office analytics on Spark: raw ticket files -> star schema -> KPI tables."""
