"""Bar cleaning, market structure and state estimation as Spark jobs."""
