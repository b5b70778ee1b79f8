"""Voice-volume analytics over forum, news and social posts, built on Spark DataFrames."""
