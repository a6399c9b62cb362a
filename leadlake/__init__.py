"""Lead lakehouse on Spark: medallion refinement, identity resolution, scoring, quality and activation."""
