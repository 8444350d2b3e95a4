"""Play-event analytics on Spark: cleaning, views, models, streams, serving."""
