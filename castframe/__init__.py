"""castframe: tagging known entities in video frames with Spark DataFrames."""
