"""Vector galleries on Spark: curate, embed, search, tag, project, evaluate."""
