"""triagelake: security analytics and fair decisions as Spark jobs."""

SEED = 8414
