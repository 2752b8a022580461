"""larder: catalogue analytics and text-corpus preparation as Spark jobs."""
